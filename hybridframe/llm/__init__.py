"""Operators for preparing training text: deduplication, sharding, quality, mixing, tokens, languages, licenses."""
