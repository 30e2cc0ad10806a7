"""Operators for training data: deduplication, archives, mixing, filters, tokens and language models."""
