"""Operators for preparing training text: deduplication, decontamination, tokens, languages, quality, URLs."""
