"""Operators of a training-data pipeline: dedup, filters, search, tokens, archives, mixing."""
