"""Training-data operators: tokenising, search, deduplication, sharding, scans and classifiers.

Nothing outside this package imports it, so it can be removed without touching the rest.
"""
