"""Operators for large training-text corpora, each on Spark DataFrames."""
