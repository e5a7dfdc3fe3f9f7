"""Streams of arriving records (an extra; the batch operators do the work)."""
