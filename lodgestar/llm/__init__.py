"""Operators on corpora of training text: selection, cleaning, near-duplicates, search, packing."""
