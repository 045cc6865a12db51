"""Operators for training-data pipelines: text, pages, conversations, vectors.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
