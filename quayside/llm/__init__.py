"""Operators for building training corpora: scoring, deduplication, packing,
archives, vector search, tokenising and sharding.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
