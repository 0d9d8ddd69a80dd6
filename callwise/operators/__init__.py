"""Operators: each takes DataFrames and returns a DataFrame, or is a Spark ML estimator."""
