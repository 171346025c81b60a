"""Training-data operators: deduplication, tokenisation, archives, sharding, packing and filters.

Nothing outside this folder (but ``corpus_pipeline.py``) imports it.
"""
