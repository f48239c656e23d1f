"""The models and queries, each a function from DataFrames to a DataFrame."""
