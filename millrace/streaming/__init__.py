"""Incremental runs of the batch upsert."""
