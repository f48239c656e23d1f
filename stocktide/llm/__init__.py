"""Operators for preparing training data at corpus scale: fingerprints, deduplication, tokenising, packing, filtering.

Nothing outside this subpackage imports it. `queries.QUERIES` holds one query per operator.
"""
