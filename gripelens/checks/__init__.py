"""Queries over the driver tables, and the same results in SQL."""
