"""Registered queries: each binds operators to the fixture tables and carries its DuckDB oracle."""
