"""Test scenarios derived from the given tables, as Spark views and as DuckDB views."""
