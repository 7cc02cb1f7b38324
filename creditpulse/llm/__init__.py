"""Operators for large training-data corpora (token counts, filters, dedup, mixing)."""
