"""Operators for preparing training text: scores, duplicates, mixing, formatting, extraction and token files."""
