"""Cleaning steps, each a function from DataFrame to DataFrame without an action."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.windows import Order, prefix_sums, sort_columns
from millrace.session import staged


def drop_null(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(required))


def fill_const(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL to a constant per column; the column keeps its type."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items()}
    )


def exact_median(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "median") -> DataFrame:
    """Interpolated median per group (or of the whole table).

    Equal values are counted map-side, the distinct ones are ranked in ranges, and
    the one or two in the middle are picked: no task ever holds all values, as the
    built-in exact percentile does.
    """
    keys = list(keys)
    counts = staged(
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")),
        "values",
    )
    pos = prefix_sums(counts, [(value, False)], {"_upto": F.col("_n")}, keys, {"_all": "_upto"})
    start = F.col("_upto") - F.col("_n")
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    holds_low = (start <= low) & (low < F.col("_upto"))
    holds_high = (start <= high) & (high < F.col("_upto"))
    v = F.col(value).cast("double")
    return (
        pos.where(holds_low | holds_high)
        .groupBy(*keys)
        .agg(((F.min(v) + F.max(v)) / F.lit(2.0)).alias(out))
    )


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """NULL to the median of the non-NULL values (a scalar subquery, no join)."""
    median = exact_median(df, col).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), median.cast(dict(df.dtypes)[col])))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key, the first in `order`; ties need a unique last column.

    Spark turns the filter on the row number into a per-task limit before the shuffle
    (WindowGroupLimit), so a key that holds a third of the rows sends one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key; equal stamps are decided by the highest `ties`."""
    return first_per_key(df, keys, [(c, True) for c in (stamp, *ties)])


def keep_in_range(df: DataFrame, col: str, cond: Column) -> DataFrame:
    return df.where(F.col(col).isNull() | cond)


def repair_order(df: DataFrame, start: str, end: str) -> DataFrame:
    """An end before its start becomes the start; NULL stays NULL."""
    return df.withColumn(end, F.when(F.col(end) < F.col(start), F.col(start)).otherwise(F.col(end)))


def keep_known(child: DataFrame, parent: DataFrame, on: Mapping[str, str] | str) -> DataFrame:
    """Child rows whose key exists in the parent (semi join, no key list anywhere)."""
    return child.join(_parent_keys(parent, on), _names(on), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str] | str) -> DataFrame:
    """Child rows whose key is NULL or missing from the parent."""
    return child.join(_parent_keys(parent, on), _names(on), "left_anti")


def _names(on):
    return [on] if isinstance(on, str) else list(on)


def _parent_keys(parent: DataFrame, on) -> DataFrame:
    if isinstance(on, str):
        return parent.select(on)
    return parent.select(*[F.col(p).alias(c) for c, p in on.items()])


def not_after(df: DataFrame, col: str, as_of: str) -> DataFrame:
    return df.where(F.col(col) <= F.lit(as_of).cast("date"))


# --- quality noise, decided by the key so that every run repeats it -----------


def _hit(key: Column, rate: int, seed: int) -> Column:
    """True for about `rate` percent of the keys."""
    return F.pmod(key * F.lit(37) + F.lit(seed), F.lit(100)) < F.lit(rate)


def inject_nulls(df: DataFrame, cols: Sequence[str], key: str, rate: int, seed: int = 0) -> DataFrame:
    return df.withColumns(
        {
            c: F.when(~_hit(F.col(key), rate, seed + 11 * i), F.col(c))
            for i, c in enumerate(cols)
        }
    )


def inject_variants(
    df: DataFrame, col: str, variants: Mapping[str, Sequence[str]], key: str, rate: int, seed: int = 0
) -> DataFrame:
    """Replace a category by one of its variants; values without variants stay."""
    pick = F.col(col)
    for value, names in variants.items():
        choice = F.element_at(
            F.array(*[F.lit(n) for n in names]),
            (F.pmod(F.col(key), F.lit(len(names))) + 1).cast("int"),
        )
        pick = F.when(F.col(col) == value, choice).otherwise(pick)
    return df.withColumn(col, F.when(_hit(F.col(key), rate, seed), pick).otherwise(F.col(col)))


def inject_date_jitter(
    df: DataFrame, col: str, key: str, max_days: int, rate: int, seed: int = 0
) -> DataFrame:
    shift = (F.pmod(F.col(key), F.lit(2 * max_days + 1)) - F.lit(max_days)).cast("int")
    return df.withColumn(
        col, F.when(_hit(F.col(key), rate, seed), F.date_add(F.col(col), shift)).otherwise(F.col(col))
    )
