"""Staging views, models, reports, data-quality checks and the batch pipeline."""
