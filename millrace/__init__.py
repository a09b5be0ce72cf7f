"""Incremental lakehouse tables and mergeable marts on Spark DataFrames."""
