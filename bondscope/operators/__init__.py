"""Report operators, each from DataFrames to a DataFrame."""
