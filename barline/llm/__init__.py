"""Operators for preparing training corpora: dedup, packing, tokenising, formatting, filtering."""
