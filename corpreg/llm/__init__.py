"""Operators for preparing training data: deduplication, packing, scoring,
filtering, formatting and search over text and vectors. Nothing outside this
subpackage imports it."""
