"""Relational operators of the library (DataFrame in, DataFrame out)."""
