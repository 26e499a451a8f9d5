"""Operators that prepare text for training: deduplication, quality, leaks, scoring, tokens.

Nothing else in the library imports this package.
"""
