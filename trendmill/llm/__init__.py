"""Operators for building training corpora, and the queries that run them over whole tables.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` uses it.
"""
