"""Operators for preparing text, page and vector corpora at scale."""
