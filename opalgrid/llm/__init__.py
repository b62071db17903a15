"""Operators that prepare training text: fingerprints, packing, scoring, tokens, duplicates, search."""
