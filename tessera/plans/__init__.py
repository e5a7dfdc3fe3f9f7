"""Whole plans: candidate, training, prediction and evaluation runs."""
