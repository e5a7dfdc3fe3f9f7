"""Tessera: record linkage and training-data processing as Spark DataFrames."""
