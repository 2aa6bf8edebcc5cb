"""Operators: DataFrame in, DataFrame (or a predicate) out."""
