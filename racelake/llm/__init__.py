"""Training-data pipeline operators (op1-op10) and the corpus pipeline.

Nothing else in the library imports this subpackage.  Each operator module
documents its method, its results on nulls, empty and very long texts, ties,
repeated rows and empty tables; ``queries`` holds the thin contract queries.
"""
