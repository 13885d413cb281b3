"""Operators for preparing training text: tokens, extraction, duplicates, quality, search, packing and sharding."""
