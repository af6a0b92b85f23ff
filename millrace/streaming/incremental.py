"""The keyed upsert, fed by files as they arrive.

Each micro-batch is reduced to its newest row per key and merged into a snapshot table.
The batch number is part of the commit, so a batch repeated after a failure is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.cleaning import latest_per_key
from millrace.operators.merge import upsert
from millrace.sources import snapshots


def merge_batch(
    batch: DataFrame, batch_id: int, root: str, keys: Sequence[str], stamp: str, ties: Sequence[str], by: str | None = None
) -> None:
    """Merge one micro-batch into the table at `root`, at most once.

    A row that comes late changes nothing: a stored row gives way only to a newer `stamp`.  With `by`, a
    whole-number expression of the keys, a new table is stored in ranges of it, and a batch reads and
    rewrites only the ranges it has keys in.
    """
    spark, keys = batch.sparkSession, list(keys)
    operation = f"MERGE batch {batch_id}"
    log = snapshots.history(spark, root)
    if log.where(F.col("operation") == operation).limit(1).count():
        return
    newest = latest_per_key(batch, keys, stamp, ties)

    def merged(stored: DataFrame, newest: DataFrame) -> DataFrame:
        # At most as many stored rows as the batch has keys.
        known = stored.join(newest.select(*keys), keys, "left_semi").select(*keys, F.col(stamp).alias("_stored"))
        fresh = newest.join(known, keys, "left").where(F.col("_stored").isNull() | (F.col(stamp) > F.col("_stored")))
        return upsert(stored, fresh.drop("_stored"), keys)

    if snapshots.current_version(spark, root) < 0:
        snapshots.publish(newest, root, operation, by)
    elif any(p.by for p in snapshots.parts(spark, root)):
        snapshots.merge(newest, root, keys, operation, combine=merged)
    else:
        snapshots.publish(merged(snapshots.read(spark, root), newest), root, operation)


def upsert_files(
    spark: SparkSession,
    source: str,
    schema: str,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    stamp: str,
    ties: Sequence[str] = (),
    files_per_batch: int = 1000,
    by: str | None = None,
) -> StreamingQuery:
    """Merge all files not seen yet, then stop; run it again for the next ones.  `by` as in `merge_batch`."""
    arrivals = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda df, n: merge_batch(df, n, root, keys, stamp, ties, by))
        .start()
    )
