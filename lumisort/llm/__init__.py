"""Training-data operators: quality rules, language ID, deduplication, mixing, URL
filters and byte-level BPE, each a DataFrame -> DataFrame function on whole tables.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
