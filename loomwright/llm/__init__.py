"""Operators for large training corpora: overlap, near-duplicates, splitting, packing, quality, tokens, look-alikes."""
