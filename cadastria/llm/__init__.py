"""Operators for training-data corpora and the queries that apply them to whole tables."""
