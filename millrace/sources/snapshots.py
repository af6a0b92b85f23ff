"""Versioned path-addressed tables on plain Parquet.

Below `<root>/v=<n>/` lies what a writer added, `<root>/_log/` holds one JSON row per commit.  The commit names
the folders a version is made of, so a version may share folders with the one before: an append adds folders, a
merge replaces those of the key ranges it touches, and the others stay as they are.  A version becomes visible
with its log row, so a table can be rebuilt from a plan that reads its current version, a writer that dies
leaves no trace readers see, and no file is ever changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merge import upsert
from millrace.session import rows_seen
from millrace.sources.files import delete, path_exists

_LOG = "version long, committed_at timestamp, operation string, row_count long"
_COMMIT = f"{_LOG}, parts array<struct<tbl: string, by: string, part: string, folder: string, row_count: bigint>>"
_PART = "_part"


class Part(NamedTuple):
    """A folder of a version: its table, what the table is cut by and which piece it is (NULL: not cut), its rows."""

    tbl: str
    by: str | None
    part: str | None
    folder: str
    row_count: int


def history(spark: SparkSession, root: str) -> DataFrame:
    """version, committed_at, operation, row_count, newest first."""
    if not path_exists(spark, f"{root}/_log"):
        return spark.createDataFrame([], _LOG)
    return spark.read.schema(_LOG).json(f"{root}/_log").orderBy(F.desc("version"))


def current_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, -1 for a new table."""
    row = history(spark, root).agg(F.max("version").alias("v")).first()
    return -1 if row["v"] is None else row["v"]


def parts(spark: SparkSession, root: str, version: int | None = None) -> list[Part]:
    """The folders of a version.  A list of names on the driver, as any reader of files makes one."""
    v = current_version(spark, root) if version is None else version
    if v < 0:
        raise FileNotFoundError(f"no committed version below {root}")
    if not path_exists(spark, f"{root}/_log/commit={v}"):
        raise FileNotFoundError(f"no version {v} below {root}")
    row = spark.read.schema(_COMMIT).json(f"{root}/_log/commit={v}").first()
    return [Part(*p) for p in row["parts"]]


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return read_table(spark, root, "", version)


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """One of the tables of a version written by `publish_all`."""
    found = [p for p in parts(spark, root, version) if p.tbl == name]
    if not found:
        raise FileNotFoundError(f"no table {name!r} below {root}")
    return _read_parts(spark, root, found)


def _read_parts(spark: SparkSession, root: str, found: Sequence[Part]) -> DataFrame:
    return spark.read.parquet(*[f"{root}/{p.folder}".rstrip("/") for p in found])


def publish(
    df: DataFrame, root: str, operation: str, by: str | None = None, gate: Callable[[], None] | None = None
) -> int:
    """Write `df` as the next version and commit it; returns the version.

    `gate` is called between the two: if it raises, what was written is deleted and there is no new version.

    With `by`, a whole-number SQL expression of the row such as `key_ranges` gives, rows are stored in a folder
    for each of its values, and `merge` rewrites only the folders it has to.

    Both writes refuse to overwrite: of two writers that pick the same number, the second one fails
    instead of mixing files, where the store has an atomic rename or create.  On a store without one, let
    one writer at a time publish.  A directory left by a writer that died before its commit is skipped
    by taking the next free number.
    """
    return _publish({"": (df, by)}, root, operation, gate=gate)


def publish_all(tables: Mapping[str, DataFrame], root: str, operation: str) -> int:
    """Write several tables as one version with one commit: readers see all of them or none."""
    return _publish({n: (df, None) for n, df in tables.items()}, root, operation)


def append_all(
    spark: SparkSession, root: str, operation: str, added: Mapping[str, DataFrame], replaced: Mapping[str, DataFrame] | None = None
) -> int:
    """The next version: `added` tables keep their folders and get one more, `replaced` ones are written anew.

    Other tables stay as they are.  What is written grows with the frames given, not with the tables.
    """
    replaced = replaced or {}
    before = [p for p in parts(spark, root) if p.tbl not in replaced]
    cut = sorted({p.tbl for p in before if p.by is not None} & set(added))
    if cut:
        raise ValueError(f"{cut} are stored by key ranges; use merge")
    return _publish({n: (df, None) for n, df in {**added, **replaced}.items()}, root, operation, before)


def key_ranges(df: DataFrame, column: str, rows: int = 1 << 22, least: int = 16) -> str:
    """An expression that cuts a whole-number key into ranges of about `rows` rows, at least `least` of them.

    The ranges are equally wide, so keys that come later than all others get ranges of their own.
    """
    f = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    span = (f["hi"] or 0) - (f["lo"] or 0) + 1
    return f"`{column}` div {max(1, span // max(least, f['n'] // rows))}"


def merge(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    operation: str,
    update: Sequence[str] | None = None,
    combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> int:
    """Upsert `source` into the table at `root`; only folders of ranges that `source` has keys in are rewritten.

    The table must be stored with a `by` that depends on the keys alone.  `combine(stored, source)` gives the
    rows after the merge, `upsert` if it is not given.  The ranges touched are looked up once; of the others
    nothing is read.  An empty source commits a version like the one before.
    """
    spark = source.sparkSession
    before = parts(spark, root)
    by = {p.by for p in before if p.tbl == ""}
    if len(by) != 1 or None in by:
        raise ValueError(f"{root} is not stored by key ranges")
    by = by.pop()
    touched = {r[_PART] for r in source.select(_part(by)).distinct().collect()}
    old = [p for p in before if p.part in touched]
    # Of a range that nothing is stored in there is no folder: the columns come from any other.
    stored = _read_parts(spark, root, old) if old else _read_parts(spark, root, before[:1]).limit(0)
    merged = combine(stored, source) if combine else upsert(stored, source, keys, update)
    if not touched:
        return _publish({}, root, operation, before, spark)
    return _publish({"": (merged, by)}, root, operation, [p for p in before if p.part not in touched])


_NULL = "none"  # the range of rows whose `by` is NULL


def _part(by: str) -> Column:
    return F.coalesce(F.expr(by).cast("long").cast("string"), F.lit(_NULL)).alias(_PART)


def _publish(
    tables: Mapping[str, tuple[DataFrame, str | None]],
    root: str,
    operation: str,
    kept: Sequence[Part] = (),
    spark: SparkSession | None = None,
    gate: Callable[[], None] | None = None,
) -> int:
    spark = spark or next(iter(tables.values()))[0].sparkSession
    version = current_version(spark, root) + 1
    while path_exists(spark, f"{root}/v={version}"):
        version += 1
    folder = lambda name: f"v={version}/{name}".rstrip("/")
    with ThreadPoolExecutor(max(1, len(tables))) as pool:  # a short table's jobs need not wait for a long one's
        write = inheritable_thread_target(spark)(_write)  # the jobs belong to the caller's group
        written = [pool.submit(write, df, root, folder(name), name, by) for name, (df, by) in tables.items()]
    now = [*kept, *[p for w in written for p in w.result()]]
    if gate:
        try:
            gate()
        except Exception:
            delete(spark, f"{root}/v={version}")
            raise
    rows = sum(p.row_count for p in now)
    commit = spark.createDataFrame([(version, operation, rows, [tuple(p) for p in now])], _COMMIT.replace("committed_at timestamp, ", ""))
    commit = commit.select("version", F.current_timestamp().alias("committed_at"), "operation", "row_count", "parts")
    commit.coalesce(1).write.mode("errorifexists").json(f"{root}/_log/commit={version}")
    return version


def _write(df: DataFrame, root: str, folder: str, name: str, by: str | None) -> list[Part]:
    if by is None:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(f"{root}/{folder}")
        return [Part(name, None, None, folder, rows_seen(seen, df))]
    cut = df.select("*", _part(by))
    # Rows of a range come together, and adaptive execution splits a range that is too much for a task.
    cut.hint("rebalance", _PART).write.mode("errorifexists").partitionBy(_PART).parquet(f"{root}/{folder}")
    stored = df.sparkSession.read.option("basePath", f"{root}/{folder}").schema(f"{_PART} string").parquet(f"{root}/{folder}")
    counts = stored.groupBy(_PART).count().collect()  # from the files' footers; a row per folder
    if not counts:  # no rows: the columns are kept
        df.limit(0).write.mode("append").parquet(f"{root}/{folder}/{_PART}={_NULL}")
        return [Part(name, by, _NULL, f"{folder}/{_PART}={_NULL}", 0)]
    return [Part(name, by, r[_PART], f"{folder}/{_PART}={r[_PART]}", r["count"]) for r in sorted(counts)]
