"""Operators for large text corpora: duplicates, private data, tokens, search, toxicity, packing."""
