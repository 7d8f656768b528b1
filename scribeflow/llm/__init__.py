"""Operators for large-scale training-data preparation (ten operators and their queries)."""
