"""Operators for training corpora: deduplication, filtering, mixing, counting and packing of documents."""
