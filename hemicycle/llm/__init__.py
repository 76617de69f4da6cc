"""Operators that prepare a training corpus: cleaning, deduplication, mixing, packing."""
