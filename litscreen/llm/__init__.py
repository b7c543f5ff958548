"""Operators for training-data corpora: one module each, and the queries that apply them."""
