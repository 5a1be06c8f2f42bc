"""Queries of every operator on the given tables, and their SQL twins."""
