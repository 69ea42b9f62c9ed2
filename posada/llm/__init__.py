"""Operators for preparing training corpora: archives, tokens, filters, deduplication, search and packing."""
