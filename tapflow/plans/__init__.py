"""Compositions of operators: pipelines, chart tables and snapshots."""
