"""Composite queries over the driver tables, plus their DuckDB oracle SQL."""
