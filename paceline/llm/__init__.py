"""Training-data operators: tokenizing, sharding, cleaning, near-duplicates,
packing and privacy over the ``documents`` table.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
