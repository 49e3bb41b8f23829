"""Data-mining operators for Spark: every operator maps DataFrames to a DataFrame."""
