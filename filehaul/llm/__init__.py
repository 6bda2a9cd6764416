"""Operators for preparing training text: filters, deduplication, scoring, tokens."""
