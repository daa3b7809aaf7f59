"""Operators for preparing training text at scale: deduplication, tagging, tokens, packing."""
