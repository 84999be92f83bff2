"""Queries over the driver tables, in Spark and as SQL for DuckDB."""
