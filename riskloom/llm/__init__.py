"""Operators for text corpora used as training data."""
