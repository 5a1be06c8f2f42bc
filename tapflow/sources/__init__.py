"""Readers and writers of landed pages, stage tables and snapshots."""
