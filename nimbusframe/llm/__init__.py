"""Training-data operators: language identification, quality rules, tokenizing,
deduplication at several grains, extraction, URL rules and source mixing.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
