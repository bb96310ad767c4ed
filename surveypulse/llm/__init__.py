"""Operators for training data at scale: duplicates, quality, personal data, packing, tokens, search."""
