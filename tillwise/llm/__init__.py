"""Operators for building training data at scale: dedup, scoring, tokens, mixing, search and packing.

Each operator takes a DataFrame of documents (``doc_id``, ``text`` and whatever else it names) or
vectors and returns a DataFrame. The digest queries that report their results are in ``queries``.
"""
