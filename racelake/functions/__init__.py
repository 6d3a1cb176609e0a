"""Column-expression helpers (no UDF): lap-time text, checked casts, JSON fallback, timestamps."""
