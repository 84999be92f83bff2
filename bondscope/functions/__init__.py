"""Column expressions and the report calendar."""
