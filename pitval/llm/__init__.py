"""Operators for preparing training text: quality, near copies, repeats, leaks, tokens, archives."""
