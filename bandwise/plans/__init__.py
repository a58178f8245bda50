"""Registered queries (each reads the driver tables) and their DuckDB twins."""
