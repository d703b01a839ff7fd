"""Operators for preparing training data: deduplication, mixing, filtering, packing, token files.

Nothing else in the package imports this one.
"""
