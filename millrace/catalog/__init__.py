"""The registered queries: each key with its Spark function and, where SQL can say it, its oracle."""

from millrace.catalog import (  # noqa: F401
    business,
    care,
    changes,
    files,
    quality,
    relational,
    windows,
)
from millrace.catalog.registry import ORACLES, QUERIES  # noqa: F401
