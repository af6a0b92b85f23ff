"""Operators of a training-data pipeline.  Nothing else in the library imports this subpackage."""

from millrace.llm.queries import ORACLES, QUERIES  # noqa: F401
