"""Operators for building training data: scoring, filtering, deduplication, formatting and packing of texts.

Nothing else in the library imports this subpackage.
"""
