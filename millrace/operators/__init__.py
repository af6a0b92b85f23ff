"""Reusable table operators: windows, quality checks, cleaning, upsert, joins."""
