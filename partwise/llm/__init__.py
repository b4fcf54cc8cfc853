"""Operators for preparing training data: quality, filters, duplicates, archives, tokens."""
