"""Relational operators of the pipeline (fuzzy join, golden record, risk tag,
data quality, training)."""
