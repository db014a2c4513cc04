"""Training-data operators: deduplication, packing, fingerprints, archives, secrets, search, scoring, mixing,
repair of conversations, resampling and chat formatting.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
