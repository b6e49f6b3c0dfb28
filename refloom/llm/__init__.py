"""Operators for preparing training text: cleaning, near-duplicate removal, scoring, packing and sharding."""
