"""Operators that prepare training text: deduplication, screening, formatting, packing and search."""
