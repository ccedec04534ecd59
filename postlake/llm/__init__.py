"""Operators for preparing training text, and their queries.

Nothing outside this package imports it, apart from ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py``.
"""
