"""Relational operators: DataFrame in, DataFrame out, usable with .transform."""
