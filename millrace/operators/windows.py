"""Rankings and running sums that stay distributed when one group is huge.

A plain window sorts each group in one task.  Here Spark deals the rows into ranges of (group, order)
first: a group lies in one range or in a few next to each other, whatever its size.  Each range is summed
by its own task, the totals per (group, range) are accumulated, and the two are joined.  There are
about as many totals as groups and ranges, and a group has one per range it touches.  The ranges only
decide where the work is cut: the result is exact for any cut, and the order is Spark's own, with NULL
and NaN where a plain window puts them.

The dealt rows are written once, so a recomputed task sees the same ranges.  The input is read for its
row count, for the range bounds and for the rows; a caller whose input is a join or an aggregate
passes it through `staged` first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import staged

ROWS_PER_RANGE = 1_000_000
BUCKETS = 1 << 14  # in which groups are counted to find the large ones

# A sort term: a column name with True for descending.
Order = Sequence[tuple[str, bool]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_first() for n, d in order]


def _ranges(df: DataFrame, splits: int | None) -> int:
    """With more rows the ranges grow in number, not in size."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return splits or max(least, -(-df.count() // ROWS_PER_RANGE))


def with_range(df: DataFrame, order: Order, keys: Sequence[str] = (), splits: int | None = None) -> DataFrame:
    """Add `_range`: 0, 1, ... rising with (keys, order); rows equal in both share one."""
    by = [F.col(k).asc_nulls_first() for k in keys] + sort_columns(order)
    dealt = df.repartitionByRange(_ranges(df, splits), *by)
    return staged(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def prefix_sums(
    df: DataFrame,
    order: Order,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Running sum, current row included, of each measure within `keys`.

    `order` must be unique within a group.  `totals` adds whole-group sums:
    output name -> measure name.
    """
    keys, carry = list(keys), list(df.columns)
    inputs = {out: f"_m{i}" for i, out in enumerate(measures)}
    ranged = with_range(
        df.select(*carry, *[measures[o].alias(c) for o, c in inputs.items()]), order, keys, splits
    )
    here = (
        Window.partitionBy(*keys, "_range")
        .orderBy(*sort_columns(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select(
        *carry, "_range", *[F.sum(c).over(here).alias(f"_l{c}") for c in inputs.values()]
    )

    # One row per group and range it touches from here on.
    per_range = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(c).alias(c) for c in inputs.values()]
    )
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    named = [f"_g{i}" for i in range(len(keys))]
    base = per_range.select(
        *[F.col(k).alias(g) for k, g in zip(keys, named)],
        F.col("_range").alias("_r"),
        *[F.sum(c).over(earlier).alias(f"_b{c}") for c in inputs.values()],
        *[
            F.sum(inputs[m]).over(group).alias(f"_t{i}")
            for i, m in enumerate((totals or {}).values())
        ],
    )
    joined = local.join(base, (F.col("_range") == F.col("_r")) & _same(keys, named))
    return joined.select(
        *carry,
        *[
            (F.col(f"_l{c}") + F.coalesce(F.col(f"_b{c}"), F.lit(0))).alias(out)
            for out, c in inputs.items()
        ],
        *[F.col(f"_t{i}").alias(out) for i, out in enumerate(totals or {})],
    )


def row_numbers(
    df: DataFrame,
    order: Order,
    keys: Sequence[str] = (),
    out: str = "row_num",
    splits: int | None = None,
) -> DataFrame:
    """1, 2, 3 ... within each group; `order` must end in a unique column."""
    return prefix_sums(df, order, {out: F.lit(1).cast("long")}, keys, splits=splits)


def crowded(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """True for rows whose group may have more than `ROWS_PER_RANGE` rows; None if there is no such group.

    Groups are counted by a hash of their keys, so a task sends no more counts than there are `BUCKETS`, whatever
    the number of groups.  A bucket over the limit may also be one of many small groups.
    """
    bucket = F.pmod(F.hash(*keys), F.lit(BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    over = [r["bucket"] for r in counts.where(F.col("n") > ROWS_PER_RANGE).collect()]
    return bucket.isin(over) if over else None


def prior_counts(
    df: DataFrame,
    order: Order,
    keys: Sequence[str],
    out: str,
    splits: int | None = None,
    attach: Callable[[DataFrame], DataFrame] = lambda counted: counted,
) -> DataFrame:
    """How many rows of the group come before this one.

    Groups that a task can sort are dealt whole, in one shuffle; only rows of larger ones are cut into ranges
    (all rows with `splits`).  `attach` is applied to the counted rows of either way: a join on `keys` in it
    finds groups that were dealt whole where they are.
    """

    def cut(rows: DataFrame) -> DataFrame:
        numbered = row_numbers(rows, order, keys, "_seq", splits)
        return attach(numbered.withColumn(out, F.col("_seq") - 1).drop("_seq"))

    if splits or not keys:
        return cut(df)
    before = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(order))).cast("long") - 1
    hot = crowded(df, keys)
    if hot is None:
        return attach(df.withColumn(out, before))
    return attach(df.where(~hot).withColumn(out, before)).unionByName(cut(df.where(hot)))


def ranks(
    df: DataFrame,
    order: Order,
    keys: Sequence[str] = (),
    rank: str | None = None,
    dense: str | None = None,
    percent: str | None = None,
    splits: int | None = None,
) -> DataFrame:
    """rank / dense_rank / percent_rank of the order value within each group.

    Ties collapse first (one row per distinct value, counted map-side), so a
    value held by a third of all rows is one row by the time it is sorted.
    """
    keys = list(keys)
    by = keys + [n for n, _ in order if n not in keys]
    values = staged(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), "values")
    summed = prefix_sums(
        values,
        order,
        {"_upto": F.col("_n"), "_dense": F.lit(1).cast("long")},
        keys,
        totals={"_all": "_upto"},
        splits=splits,
    )
    first = F.col("_upto") - F.col("_n") + 1
    wanted = []
    if rank:
        wanted.append(first.alias(rank))
    if dense:
        wanted.append(F.col("_dense").alias(dense))
    if percent:
        spread = (first - 1).cast("double") / (F.col("_all") - 1).cast("double")
        wanted.append(F.when(F.col("_all") > 1, spread).otherwise(F.lit(0.0)).alias(percent))
    return _attach(df, by, summed, wanted)


def _attach(df: DataFrame, by: Sequence[str], values: DataFrame, wanted: Sequence[Column | str]) -> DataFrame:
    """Figures per distinct value, next to every row that holds it.

    They are written first, so that Spark knows their size when it plans the join: a few hot values are
    broadcast and the rows stay where they are.
    """
    named = [f"_v{i}" for i in range(len(by))]
    lookup = staged(values.select(*[F.col(c).alias(v) for c, v in zip(by, named)], *wanted), "figures")
    return df.join(lookup, _same(by, named)).drop(*named)


def ntiles(
    df: DataFrame,
    tiles: int,
    order: Order,
    keys: Sequence[str] = (),
    out: str = "tile",
    splits: int | None = None,
) -> DataFrame:
    """Equal-sized tiles, the larger ones first; `order` must be unique."""
    numbered = prefix_sums(
        df, order, {"_r": F.lit(1).cast("long")}, keys, totals={"_n": "_r"}, splits=splits
    )
    small = F.floor(F.col("_n") / tiles)
    extra = F.pmod(F.col("_n"), F.lit(tiles))
    edge = extra * (small + 1)
    tile = F.when(F.col("_r") <= edge, F.ceil(F.col("_r") / (small + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("_r") - edge, small))
    )
    return numbered.withColumn(out, tile.cast("long")).drop("_r", "_n")


def running_range_total(
    df: DataFrame,
    order: Order,
    measure: Column,
    out: str,
    keys: Sequence[str] = (),
    splits: int | None = None,
) -> DataFrame:
    """Running total in which rows with the same order value share one figure."""
    keys = list(keys)
    by = keys + [n for n, _ in order]
    values = staged(df.groupBy(*by).agg(F.sum(measure).alias("_s")), "values")
    summed = prefix_sums(values, order, {out: F.col("_s")}, keys, splits=splits)
    return _attach(df, by, summed, [out])


def calendar_window(*partition: str, order: str) -> Window:
    """A plain ordered window for results already aggregated to calendar periods.

    Only for tables with one row per day or month (per category): their length is
    set by the calendar, not by the data volume.
    """
    return Window.partitionBy(*(partition or [F.lit(0)])).orderBy(order)


def running_by_period(df: DataFrame, period: str, total: Column, out: str) -> DataFrame:
    """running_range_total for a calendar column.

    There are no more totals than the calendar has periods, so they fit one task and a broadcast.
    `total` is an aggregate, like F.sum("x").
    """
    totals = df.groupBy(F.col(period).alias("_p")).agg(total.alias("_s"))
    upto = calendar_window(order="_p").rowsBetween(Window.unboundedPreceding, 0)
    running = totals.select("_p", F.sum("_s").over(upto).alias(out))
    return df.join(F.broadcast(running), F.col(period).eqNullSafe(F.col("_p"))).drop("_p")


def distinct_counts(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct values per group, a row for each group that has one: distinct pairs first, then a count."""
    pairs = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct values of the group on each of its rows.

    Counted per group and joined back, instead of carrying a set on every row.
    """
    keys = list(keys)
    counts = distinct_counts(df, keys, value, out).select(*[F.col(k).alias(f"_v{i}") for i, k in enumerate(keys)], out)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_v{i}"))
    joined = df.join(counts, on, "left").drop(*[f"_v{i}" for i in range(len(keys))])
    return joined.withColumn(out, F.coalesce(out, F.lit(0).cast("long")))
