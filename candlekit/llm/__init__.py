"""Operators of a training-data pipeline: deduplication, filters, mixing, sharding, audits.

Nothing outside this package (and corpus_pipeline.py) depends on it.
"""
