"""Operators of a training-data pipeline: extraction, language, dedup, quality, PII, tokens.

Nothing outside this package (and the top-level ``corpus_pipeline``) imports it.
"""
