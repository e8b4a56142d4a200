"""Fixtures over the given tables, the registered queries and their DuckDB oracles."""
