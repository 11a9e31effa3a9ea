"""Operators for training-data pipelines, built on Spark DataFrames."""
