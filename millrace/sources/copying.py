"""Conditional typed copy and the split of a flat file into dimensions and facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cleaning import first_per_key
from millrace.operators.windows import Order
from millrace.session import metrics
from millrace.sources.files import path_exists, read_csv_typed
from millrace.sources.sinks import write_csv

# The error code and the target's name format.
FILE_NOT_FOUND = "FILE_NOT_FOUND"
TARGET_NAME = "{stem}_processed_{stamp}.csv"
_MALFORMED = "_malformed"


class SourceMissing(FileNotFoundError):
    """The copy's source does not exist."""

    code = FILE_NOT_FOUND


@dataclass(frozen=True)
class CopyResult:
    target: str
    rows_copied: int
    rows_malformed: int  # copied with NULL where a cell did not fit its type


def conditional_copy(
    spark: SparkSession, source: str, folder: str, schema: str, stem: str, stamp: str
) -> CopyResult:
    """Typed copy to a stamped target if the source exists, else SourceMissing.

    `stamp` is the caller's run time (yyyyMMdd_HHmmss), not the clock, so a re-run
    of the same job writes the same target.
    """
    if not path_exists(spark, source):
        raise SourceMissing(f"{FILE_NOT_FOUND}: {source}")
    target = f"{folder.rstrip('/')}/{TARGET_NAME.format(stem=stem, stamp=stamp)}"
    seen = Observation()
    typed = read_csv_typed(spark, source, schema, corrupt=_MALFORMED)
    typed = typed.observe(seen, F.count(_MALFORMED).alias("malformed")).drop(_MALFORMED)
    rows = write_csv(typed, target)
    return CopyResult(target, rows, metrics(seen, lambda: {"malformed": 0})["malformed"])  # nothing seen: no rows


def split_dimension(flat: DataFrame, key: str, attributes: list[str], order: Order) -> DataFrame:
    """One row per key out of a flat fact file; the first in `order` wins."""
    rows = flat.select(*dict.fromkeys([key, *attributes, *[n for n, _ in order]]))
    return first_per_key(rows, [key], order).select(key, *attributes)
