"""Operators for preparing text to train language models on. Nothing outside imports this package."""
