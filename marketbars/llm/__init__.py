"""Operators of a large-scale training-data pipeline (texts, vectors, URLs)."""
