"""Operators for preparing training data: packing, archives, filters, near-duplicates, search."""
