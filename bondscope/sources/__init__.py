"""Reading input tables and writing, publishing and archiving results."""
