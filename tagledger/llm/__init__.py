"""Operators for preparing training text: tokens, licenses, mixing, sketches, near-duplicates, quality."""
