"""Lavra: document mining and association graphs on Spark DataFrames."""
