"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import configure

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Stands for a null id inside an operator, so that ids stay plain longs there.
NULL_ID = -(2**63)


#: Rows of text are large, so few of them go to a worker at a time, and fewer still where they are long.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings, Arrow batches that stay small with long texts, and workers that find the code."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Workers hold what their operator bounds, not a share of the shuffle, and a worker's start costs more than a larger task.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    _ship(spark)
    return spark


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the package to the workers, unless it is on the path they start with."""
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    installed = root.name in ("site-packages", "dist-packages")
    if app in _SHIPPED or installed or root in (Path.cwd(), *paths):
        return
    name = Path(tempfile.mkdtemp(prefix="code-")) / "millrace.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted((root / "millrace").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(name))
    _SHIPPED.add(app)


def pieces_of(batches, column: str, limit: int):
    """Slices of Arrow batches whose texts come to about `limit` bytes; a longer text is a slice of its own."""
    for b in batches:
        size = pc.binary_length(b[column]).fill_null(0).to_numpy(zero_copy_only=False)
        size = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = 0
        while at < len(b):
            to = max(at + 1, int(np.searchsorted(size, size[at] + limit, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def finite_vector(vec: Column) -> Column:
    """True where a vector is there and every component is a finite number."""
    bad = F.exists(
        vec,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.coalesce(vec.isNotNull() & ~bad, F.lit(False))


def one_per_id(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): one row per id.  Rows that repeat an id count once, with the least of their vectors
    that is not null; a null id is one id like any other and reads NULL_ID from here on."""
    return (
        df.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
            F.col(vec_col).alias("vec"),
        )
        .groupBy("id")
        .agg(F.min("vec").alias("vec"))
    )


def null_id_back(col: Column) -> Column:
    return F.when(col != F.lit(NULL_ID), col)


def one_task_each(df: DataFrame) -> DataFrame:
    """The rows of a short table, such as one of files, dealt over as many tasks.

    The number is given outright, as partitions of a few bytes would else be put together again.
    """
    return df.repartition(max(1, df.count()))
