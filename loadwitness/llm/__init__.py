"""Operators for training data: each takes and returns DataFrames; ``queries`` applies them to whole tables."""
