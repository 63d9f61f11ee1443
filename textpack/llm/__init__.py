"""Operators for large training corpora: deduplication, filters, extraction, encoding.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py``
depends on it.
"""
