"""Operators for training-data corpora: filters, deduplication, tokens, extraction.

Nothing outside this folder imports it, but for the guarded entry point.
"""
