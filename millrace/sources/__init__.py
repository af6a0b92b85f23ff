"""Readers and writers: files, snapshot tables, conditional copy, the test tables."""
