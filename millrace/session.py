"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Runtime settings every plan in this package assumes.  They only steer the
# physical plan (adaptive skew handling, time zone), never the result, except
# the time zone which must be fixed for date casts.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A compressed shuffle block of 64 MB, the default, takes a task of sorts and hash tables twenty times that in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Split a skewed join partition even where that costs one more shuffle for
    # the aggregate above it: one order or customer may hold a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package defaults; `conf` overrides them."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_CREATED: dict[str, list[str]] = {}  # scratch folders by application


def metrics(seen: Observation, otherwise: Callable[[], dict]) -> dict:
    """What an observation saw; `otherwise` where it saw nothing at all.

    Where the optimiser finds out that no row can come, it takes the observation out of the plan with the rest.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return otherwise()


def rows_seen(seen: Observation, df: DataFrame) -> int:
    """The observed count named `rows` of what was written from `df`."""
    return metrics(seen, lambda: {"rows": df.count()})["rows"]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared `spark.checkpoint.dir`.

    A machine-local folder is used only in local mode, where driver and executors are one process; on a
    cluster without the setting this fails.  `clean_up` deletes what a session made; it also runs when
    the driver's Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _CREATED:
        _CREATED[app] = []
        atexit.register(_at_exit, spark)
    _CREATED[app].append(path)
    return path


def clean_up(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch folders of this session from number `since` on; returns how many were left.

    Frames that read them are gone with them, so call it once results are written elsewhere.
    """
    paths = _CREATED.get(spark.sparkContext.applicationId, [])
    done = 0
    for path in paths[since:]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        done += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
    del paths[since:]
    return done


def scratch_count(spark: SparkSession) -> int:
    """How many scratch folders this session has; a mark for `clean_up`."""
    return len(_CREATED.get(spark.sparkContext.applicationId, []))


def _at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        clean_up(spark)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a derived frame to the shared folder once and go on from the files.

    For frames an operator reads several times (a range-cut window takes three passes):
    the joins behind them run once, a lost executor costs a re-read instead of the whole
    lineage, and column pruning still reaches the scan.  Plain scans need no staging.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
