"""Registered queries on the driver's tables and their DuckDB oracles."""
