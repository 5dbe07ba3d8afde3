"""Operators for preparing training text: quality, decontamination, deduplication, mixing, scoring, formatting."""
