"""Test support: the independent SQL oracle (DuckDB dialect)."""
