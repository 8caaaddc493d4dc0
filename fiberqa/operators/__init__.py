"""Operators: DataFrame in, DataFrame out, grouping keys always a parameter."""
