"""Training-data operators: scoring, deduplication, tokenising, filtering.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
