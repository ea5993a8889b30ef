"""Operators that prepare training text: dedup, filters, language models, tokens, packing."""
