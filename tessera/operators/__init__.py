"""Linkage operators on DataFrames: retrieval, features, labels, model, threshold, evaluation, output, profile."""
