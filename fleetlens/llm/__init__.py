"""Training-data operators: dedup, quality, secrets, extraction, mixing, packing, fingerprints.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
