"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import word_count
from millrace.session import staged


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    The sum of all sizes is shared in proportion to the weights, which repeat over the sources in code
    point order (a null source comes last).  A source gets at most `most` times its size; what it leaves
    is shared among the others, again by weight, until none is above.  That is the one level at which
    sum(least(most * size, level * weight)) is the whole: taking the sources by most * size / weight,
    the first whose ratio is not below the level the rest would get fixes it.
    The windows run over one row per source.
    """
    named = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).cast("long")
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    rows = rows.withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    all_rows = W.partitionBy()
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("pos", F.row_number().over(by_ratio))
    rows = rows.withColumn("level", left.cast("double") / share)
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("pos", "level"))
    rows = rows.withColumn("level", F.min(fits).over(all_rows)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
    keep_rows: bool = True,
) -> DataFrame:
    """How many copies of each row the mix takes: (doc, id, size, source_size, target, copies).

    A row's size is its number of words (null text: none).  All rows of a source expect the same number
    of copies, target / source_size, so the prefix sum of expected copies is that number times the row's
    rank in its source.  One offset per source, from a hash of `seed` and the source, is added, and a row
    is taken once for each whole number its step crosses: never more than `most` times, `most` not being
    below the expectation.  Ranks go by size, so that words, not only rows, come out near the target:
    they miss it by about the largest document at most.  Ties go by id; rows equal in both are alike.

    Rows are dealt by range of (source, size, id), so a hot source spreads over many tasks; ranks are the
    position in the partition plus the rows of the source in the partitions before, one row per partition
    and source.  The dealt rows are written once, so a recomputed task cannot change them.  They are
    numbers and sources alone: the range of the largest documents would hold most of the text.  Whole rows
    are written with a number and meet their copies by it, in a hash join that sorts no text.

    Nulls: a null source is a source of its own, a null text has size 0, a null id comes first.  A source
    without words has target 0 and none of its rows is taken.  Empty input gives empty output.  `doc`
    holds the input row whole, whatever its columns are called (null with keep_rows=False).
    """
    narrow = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")]
    # Written first, as the bounds of the ranges take one more pass.
    if keep_rows:
        whole = staged(docs.select(F.struct("*").alias("doc"), *narrow).withColumn("row", F.monotonically_increasing_id()), "rows")
        rows = whole.drop("doc")
    else:
        rows = staged(docs.select(*narrow), "sizes").withColumn("doc", F.lit(None).cast("string"))
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = staged(dealt.withColumn("at", F.monotonically_increasing_id()), "dealt")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))

    parts = dealt.groupBy("source", "part").agg(
        F.min("at").alias("first"), F.count("*").alias("n"), F.sum("size").alias("words")
    )
    parts = staged(parts, "parts")
    ahead = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("source", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    goal = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    named = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    offset = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.select("source", "source_size", "target", offset.alias("offset"), step.alias("step"))
    plan = starts.join(goal, starts["source"].eqNullSafe(goal["source"])).drop(goal["source"])

    on = (dealt["part"] == plan["part"]) & dealt["source"].eqNullSafe(plan["source"])
    rank = plan["ahead"] + dealt["at"] - plan["first"]
    crossed = F.floor(plan["offset"] + plan["step"] * (rank + 1)) - F.floor(plan["offset"] + plan["step"] * rank)
    found = dealt.join(plan, on).select(
        dealt["row" if keep_rows else "doc"],
        dealt["id"],
        dealt["size"],
        plan["source_size"],
        plan["target"],
        F.least(crossed, F.lit(most)).cast("long").alias("copies"),
    )
    if keep_rows:
        found = whole.select("row", "doc").join(found.hint("shuffle_hash"), "row").drop("row")
    return found


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: each input row as often as `copies` says, with the input's columns."""
    taken = copies(docs, **options).where("copies > 0")
    again = taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
