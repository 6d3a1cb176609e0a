"""Generic DataFrame operators (no domain names): as-of joins, intervals, matching, selection, windows, incremental loads."""
