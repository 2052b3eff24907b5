"""Relational and machine-learning steps: DataFrames in, DataFrame out."""
