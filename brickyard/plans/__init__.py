"""Concrete plans over the driver tables: how the TPC-H-style tables map onto
the star (``sales_star``) and the registry of runnable queries with their
DuckDB oracle SQL (``registry``)."""
