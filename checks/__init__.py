"""Registered queries: library calls on views of the given tables, each with its SQL."""
