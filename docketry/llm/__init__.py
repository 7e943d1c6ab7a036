"""Operators for training-text and fuzzy-matching work. Nothing outside this package imports it."""
