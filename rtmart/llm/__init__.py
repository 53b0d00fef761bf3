"""Training-data operators and the corpus pipeline's building blocks.

Nothing outside this package imports it, apart from the guarded registration
in ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
