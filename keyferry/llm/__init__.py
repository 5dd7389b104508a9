"""Operators for preparing text corpora: dedup, mixing, tokens, near duplicates, scans and classifiers."""
