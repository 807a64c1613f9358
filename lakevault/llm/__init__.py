"""Operators that prepare training data: dedup, packing, formatting, archives, scans, search, mixing."""
