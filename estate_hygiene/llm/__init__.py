"""Operators for preparing text, page and vector collections for training."""
