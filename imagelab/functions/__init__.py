"""Column expressions and per-batch helpers."""
