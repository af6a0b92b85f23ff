"""Keyed upsert and batch change as DataFrame compositions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import Rules, apply_rules
from millrace.session import staged


def checked_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, failing while it runs if a key occurs twice.

    One row per key leaves the aggregate, so a duplicated key cannot multiply
    target rows; the error names no row, only the fact.
    """
    keys = list(keys)
    rest = [c for c in source.columns if c not in keys]
    one = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in rest]
    )
    ok = F.when(F.col("_n") == 1, True).otherwise(
        F.raise_error(F.lit("upsert source has more than one row for a key")).cast("boolean")
    )
    return one.where(ok).select(*source.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
) -> DataFrame:
    """MERGE: matched rows take the source's `update` columns, new keys are inserted.

    The target is read through a left join and the inserts through an anti join on
    keys only, so a small increment can be broadcast by Spark and the target is not
    shuffled for it.  Columns missing from the source keep the target's value, or
    are NULL on insert.
    """
    keys = list(keys)
    update = [c for c in (update or source.columns) if c not in keys]
    incoming = checked_source(source, keys)
    side = incoming.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_s_{c}") for c in update],
        F.lit(True).alias("_hit"),
    )
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    kept = target.join(side, on, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update else c
            for c in target.columns
        ]
    )
    # Keys that match, found by probing with the increment: at most its own size.
    matched = target.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    new = incoming.join(matched, keys, "left_anti")
    return kept.unionByName(new.select(*[c for c in target.columns if c in new.columns]), allowMissingColumns=True)


def tag_changes(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each incoming row with operation UPDATE or INSERT."""
    keys = list(keys)
    matched = (
        target.select(*keys)
        .join(source.select(*keys).distinct(), keys, "left_semi")
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    tagged = source.join(matched, keys, "left")
    return tagged.select(
        *source.columns,
        F.when(F.col("_hit"), "UPDATE").otherwise("INSERT").alias("operation"),
    )


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before, updated, inserted and after."""
    before = target.agg(F.count(F.lit(1))).scalar()
    tags = tag_changes(target, source, keys).agg(
        F.count_if(F.col("operation") == "UPDATE").alias("updated_rows"),
        F.count_if(F.col("operation") == "INSERT").alias("inserted_rows"),
    )
    return tags.select(
        before.alias("rows_before"), "updated_rows", "inserted_rows"
    ).withColumn("rows_after", F.col("rows_before") + F.col("inserted_rows"))


class OrderBatch(NamedTuple):
    """What a batch adds, and the stock after it; no added row and the old stock if the batch was rejected."""

    orders: DataFrame
    items: DataFrame
    stock: DataFrame


def order_batch(
    orders: DataFrame,
    items: DataFrame,
    stock: DataFrame,
    new_orders: DataFrame,
    new_items: DataFrame,
    order_rules: Rules,
    item_rules: Rules,
    order_key: Sequence[str] = ("order_id",),
    item_key: Sequence[str] = ("order_id", "product_id"),
) -> OrderBatch:
    """Add a batch of orders with their items and lower the stock, or change nothing.

    One broken rule anywhere, a key that the batch repeats or that is stored already, or one product sold
    beyond its stock rejects the whole batch: every added row and every stock change depends on the
    number of faults, which is counted once.  Stored orders and items are only probed for the batch's keys;
    `snapshots.append_all` stores the three under one commit without touching them.
    """
    sold = staged(new_items.groupBy("product_id").agg(F.sum("quantity").alias("_sold")), "sold")
    short = stock.join(sold, "product_id").where(F.col("stock") < F.col("_sold"))
    broken = (
        apply_rules(new_orders, order_rules)
        .select("reasons")
        .unionByName(apply_rules(new_items, item_rules).select("reasons"))
        .where(F.size("reasons") > 0)
    )
    faults = [broken, short]
    for stored, new, key in ((orders, new_orders, order_key), (items, new_items, item_key)):
        keys = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        # The batch is the small side: its keys are looked for in the stored table, whole ones only among the rows whose
        # first column the batch has too.
        known, first = stored.select(*key), key[0]
        if len(key) > 1:
            met = staged(known.select(first).distinct().join(new.select(first), first, "left_semi"), "met")
            known = known.join(met, first, "left_semi")
        faults += [keys.where("_n > 1"), known.join(keys.select(*key), list(key), "left_semi")]
    fault = F.lit(1).alias("fault")
    bad = faults[0].select(fault)
    for f in faults[1:]:
        bad = bad.unionByName(f.select(fault))
    bad = staged(bad.agg(F.count("fault").alias("faults")), "faults").scalar()
    lowered = stock.join(sold, "product_id", "left").withColumn(
        "stock",
        F.when((bad == 0) & F.col("_sold").isNotNull(), F.col("stock") - F.col("_sold")).otherwise(
            F.col("stock")
        ),
    )
    return OrderBatch(new_orders.where(bad == 0), new_items.where(bad == 0), lowered.drop("_sold"))


def apply_order_batch(orders: DataFrame, items: DataFrame, stock: DataFrame, *batch, **keys) -> OrderBatch:
    """The three tables after `order_batch`."""
    done = order_batch(orders, items, stock, *batch, **keys)
    return OrderBatch(orders.unionByName(done.orders), items.unionByName(done.items), done.stock)
