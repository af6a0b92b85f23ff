"""Joins, sub-queries and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_LIMIT = 1000  # of a report


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer comparison of the keys of two tables: matched, left only, right only."""
    a = left.select(F.col(key).alias("_l")).distinct()
    b = right.select(F.col(key).alias("_r")).distinct()
    return a.join(b, F.col("_l") == F.col("_r"), "full").select(
        F.coalesce("_l", "_r").alias(key),
        F.when(F.col("_r").isNull(), "left_only")
        .when(F.col("_l").isNull(), "right_only")
        .otherwise("matched")
        .alias("match"),
    )


def above_average(df: DataFrame, value: str) -> DataFrame:
    """Rows above the global mean (an uncorrelated scalar subquery)."""
    mean = df.agg(
        F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))
    ).scalar()
    return df.where(F.col(value).cast("double") > mean)


def rows_at_group_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """All rows that reach their group's maximum, ties included.

    One pass: the filter on the rank becomes a per-task limit before the shuffle, so of
    a hot group only each task's best rows travel.
    """
    best_first = Window.partitionBy(key).orderBy(F.desc(value))
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .withColumn("_rank", F.rank().over(best_first))
        .where("_rank = 1")
        .drop("_rank")
    )


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, center: str, low: int, high: int) -> DataFrame:
    """Rows of both sides with equal `keys` whose whole number `at` lies `low` to `high` above `center`.

    Numbers fall into bins as wide as the band, and the band of a center meets two bins at most.  So the bin
    is part of the join key: a key that holds a large part of the rows is dealt over as many tasks as it has
    bins, and rows far from each other never meet.  Rows without a key or number are in no pair; the `keys`
    come once, from the left.
    """
    width = high - low + 1
    if width < 1:
        raise ValueError("the band is empty")
    bins = F.array_distinct(F.array(*[F.floor((F.col(center) + x) / width) for x in (low, high)]))
    near = right.where(F.col(center).isNotNull()).withColumn("_bin", F.explode(bins))
    near = near.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    binned = left.withColumn("_bin", F.floor(F.col(at) / width)).withColumnRenamed("_bin", "_left_bin")
    on = (F.col("_left_bin") == F.col("_bin")) & (F.col(at) - F.col(center)).between(low, high)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return binned.join(near, on).drop("_bin", "_left_bin", *[f"_r_{k}" for k in keys])


def pivot_counts(df: DataFrame, row: str, column: str, most: int = 1000, null_label: str = "none") -> DataFrame:
    """A column of counts for every label of `column`, 0 where a pair does not occur; NULL has the column `null_label`.

    The labels are found first.  More than `most` of them raise, as does one that reads like `null_label`:
    nothing is dropped to make the table fit.
    """
    text = F.col(column).cast("string")
    found = [r[0] for r in df.select(text.alias("label")).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} labels")
    if None in found and null_label in found:
        raise ValueError(f"{null_label!r} is a label of {column}")
    labels = sorted(null_label if x is None else x for x in found)
    if not labels:
        return df.select(row).distinct()
    counts = df.groupBy(row, F.coalesce(text, F.lit(null_label)).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(row).pivot("_label", labels).agg(F.sum("_n")).fillna(0, labels)


def check_limit(limit: int) -> int:
    """Report sizes are 1..1000."""
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return limit


def top_k(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows of an order; each task keeps `limit` rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(limit)


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """value * 100 / sum(value); the total is a scalar subquery."""
    total = df.agg(F.sum(value).cast("double")).scalar()
    return df.withColumn(
        out,
        F.round(F.try_divide(F.col(value).cast("double") * F.lit(100.0), total), digits),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from the smallest to the largest value; the upper edge belongs to the last bin.

    The bounds come from the data, so every row with a value falls in a bin.
    """
    v = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(v).alias("low"), ((F.max(v) - F.min(v)) / bins).alias("width"))).scalar()
    placed = df.where(F.col(value).isNotNull()).select(v.alias("v"), span.alias("s"))
    # One value only: no width, one bin.
    b = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("s.low"), F.col("s.width"))), F.lit(0))
    return (
        placed.groupBy(F.least(b, F.lit(bins - 1)).cast("long").alias("bin"), "s")
        .agg(F.count(F.lit(1)).alias("rows_in_bin"))
        .select(
            "bin",
            (F.col("s.low") + F.col("bin") * F.col("s.width")).alias("bin_start"),
            (F.col("s.low") + (F.col("bin") + 1) * F.col("s.width")).alias("bin_end"),
            "rows_in_bin",
        )
    )
