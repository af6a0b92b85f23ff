"""Profiles, checks, rules with quarantine, and the gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import is_blank
from millrace.session import metrics, rows_seen


class QualityError(RuntimeError):
    """Raised by `require` when a check failed."""


# --- profiles ----------------------------------------------------------------


def _melt(row: DataFrame, names: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    """A one-row frame of equal-typed columns to (name, value) rows."""
    pairs = [F.struct(F.lit(n).alias(name_col), F.col(f"`{n}`").alias(value_col)) for n in names]
    return row.select(F.inline(F.array(*pairs)))


def null_profile(df: DataFrame, only_present: bool = False) -> DataFrame:
    """(column_name, null_count), all columns counted in one pass."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    out = _melt(row, df.columns, "column_name", "null_count")
    return out.where("null_count > 0") if only_present else out


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """total_rows, distinct_keys, duplicate_rows and PASS/FAIL."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).select(
        "total_rows",
        "distinct_keys",
        (F.col("total_rows") - F.col("distinct_keys")).alias("duplicate_rows"),
        F.when(F.col("total_rows") == F.col("distinct_keys"), "PASS").otherwise("FAIL").alias("status"),
    )


def duplicate_values(df: DataFrame, cols: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the row and column count."""
    cols = [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type")
        )
        for i, (n, t) in enumerate(df.dtypes)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(F.array(*cols))
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("tbl"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def stage_counts(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each filter of a chain, in one pass over the input."""
    kept, aggs, names = F.lit(True), [F.count(F.lit(1)).alias("s0")], ["raw"]
    for i, (name, cond) in enumerate(steps, 1):
        kept = kept & F.coalesce(cond, F.lit(False))
        aggs.append(F.count_if(kept).alias(f"s{i}"))
        names.append(name)
    rows = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(n).alias("stage"),
            F.col(f"s{i}").alias("rows_left"),
            (F.col(f"s{max(i - 1, 0)}") - F.col(f"s{i}")).alias("rows_removed"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


Step = tuple[str, Callable[[DataFrame], DataFrame]]


def step_counts(raw: DataFrame, steps: Sequence[Step], write: Callable[[DataFrame], object]) -> DataFrame:
    """Rows left after each step of a chain, and how many the step took, counted while `write` runs the chain once.

    Unlike `stage_counts` the steps may be anything, row duplicates included.  A step's rows are observed in
    the job that writes its result.  Where that job had to run tasks again, which may count rows twice, each
    step is counted by a job of its own.
    """
    spark, frames, seen = raw.sparkSession, [raw], [Observation()]
    df = raw.observe(seen[0], F.count(F.lit(1)).alias("rows"))
    for _, step in steps:
        seen.append(Observation())
        frames.append(step(frames[-1]))
        df = step(df).observe(seen[-1], F.count(F.lit(1)).alias("rows"))
    with _Watched(spark) as jobs:
        write(df)
    if jobs.ran_again():
        counts = [f.count() for f in frames]
    else:
        counts = [rows_seen(o, f) for o, f in zip(seen, frames)]
    names = ["raw", *[n for n, _ in steps]]
    rows = [(i, n, c, max(0, counts[max(i - 1, 0)] - c)) for i, (n, c) in enumerate(zip(names, counts))]
    return spark.createDataFrame(rows, "step int, stage string, rows_left long, rows_removed long")


class _Watched:
    """The jobs that a block starts on this thread."""

    def __init__(self, spark: SparkSession):
        self.context, self.group = spark.sparkContext, f"watched-{uuid.uuid4().hex}"

    def __enter__(self) -> _Watched:
        self.before = self.context.getLocalProperty(_GROUP)
        self.context.setLocalProperty(_GROUP, self.group)
        return self

    def __exit__(self, *_) -> None:
        self.context.setLocalProperty(_GROUP, self.before)

    def ran_again(self) -> bool:
        """True if a task failed or a stage was tried again, or Spark does not know any more."""
        tracker = self.context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(self.group)]
        stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
        ran = [s for s in stages if s is not None]
        return not all(jobs) or any(s.numFailedTasks or s.currentAttemptId or s.numCompletedTasks > s.numTasks for s in ran)


_GROUP = "spark.jobGroup.id"


# --- checks -------------------------------------------------------------------


def header_check(columns: Sequence[str], expected: Sequence[str]) -> dict[str, object]:
    """Compare a header with its contract; order matters for `passed`."""
    return {
        "passed": list(columns) == list(expected),
        "found": len(columns),
        "expected": len(expected),
        "missing": [c for c in expected if c not in columns],
        "extra": [c for c in columns if c not in expected],
    }


def header_check_rows(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The header check next to the row count it was made on."""
    r = header_check(df.columns, expected)
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(r["passed"]).alias("passed"),
        F.lit(r["found"]).cast("long").alias("found"),
        F.lit(r["expected"]).cast("long").alias("expected"),
        F.lit(",".join(r["missing"])).alias("missing"),
        F.lit(",".join(r["extra"])).alias("extra"),
    )


def _sum_of(cols: Sequence[Column]) -> Column:
    total = F.lit(0).cast("long")
    for c in cols:
        total = total + c
    return total


def empty_cells(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Aggregate: NULL or blank cells over the columns."""
    return _sum_of([F.count_if(is_blank(F.col(f"`{c}`"))) for c in (cols or df.columns)])


def numeric_errors(numeric: Sequence[str], positive: Sequence[str] = ()) -> Column:
    """Aggregate: cells that are no number, plus non-positive ones where that is an error.

    An empty cell counts as 0: it is no malformed number, but an empty quantity is
    still not positive.
    """
    terms = []
    for c in numeric:
        text = F.col(f"`{c}`").cast("string")
        value = F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(F.trim(text).try_cast("double"))
        bad = value.isNull()
        terms.append(F.count_if(bad | (value <= 0) if c in positive else bad))
    return _sum_of(terms)


def summary_stats(df: DataFrame, sales: str, profit: str) -> DataFrame:
    """Totals and extremes in one pass; money is summed as decimal.

    The columns may be text: a blank cell counts as 0, a cell that is no number is left out.
    """
    s, p = (_lenient(c) for c in (sales, profit))
    raw = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(s).alias("s"),
        F.count(s).alias("ns"),
        F.max(s).alias("hi"),
        F.min(s).alias("lo"),
        F.sum(p).alias("p"),
        F.count(p).alias("np"),
    )
    avg = lambda t, c: F.round(F.try_divide(F.col(t).cast("double"), F.col(c)), 2)
    r2 = lambda c: F.round(c, 2).cast("double")
    return raw.select(
        F.col("n").alias("total_rows"),
        r2("s").alias("total_sales"),
        avg("s", "ns").alias("avg_sales"),
        r2("hi").alias("max_sales"),
        r2("lo").alias("min_sales"),
        r2("p").alias("total_profit"),
        avg("p", "np").alias("avg_profit"),
    )


def _lenient(name: str) -> Column:
    text = F.trim(F.col(f"`{name}`").cast("string"))
    zero = F.lit(0).cast("decimal(18,4)")
    return F.when(text.isNull() | (text == ""), zero).otherwise(text.try_cast("decimal(18,4)"))


def validation_report(
    df: DataFrame,
    expected: Sequence[str],
    min_rows: int,
    numeric: Sequence[str],
    positive: Sequence[str] = (),
    size_bytes: int | None = None,
) -> DataFrame:
    """All checks of a file and the overall verdict, a row each, from one aggregate.

    `size_bytes` is what the file's store says (None: there is no such file); see `sources.files`.
    """
    header = header_check(df.columns, expected)
    known = [c for c in expected if c in df.columns]
    raw = df.agg(
        F.count(F.lit(1)).alias("n"),
        empty_cells(df, known).alias("blank"),
        numeric_errors([c for c in numeric if c in known], positive).alias("bad"),
    )
    exists, filled = size_bytes is not None, bool(size_bytes)
    checks = [
        ("file_exists", F.lit(exists), F.lit(int(exists)).cast("long"), 1),
        ("file_not_empty", F.lit(filled), F.lit(int(filled)).cast("long"), 1),
        ("column_headers", F.lit(header["passed"]), F.lit(header["found"]).cast("long"), header["expected"]),
        ("row_count", F.col("n") >= min_rows, F.col("n"), min_rows),
        ("null_values", F.col("blank") == 0, F.col("blank"), 0),
        ("numeric_integrity", F.col("bad") == 0, F.col("bad"), 0),
    ]
    every = F.lit(True)
    for _, passed, _, _ in checks:
        every = every & passed
    failed = _sum_of([(~p).cast("long") for _, p, _, _ in checks])
    rows = [
        F.struct(
            F.lit(n).alias("check_name"),
            p.alias("passed"),
            o.alias("observed"),
            F.lit(e).cast("long").alias("expected"),
        )
        for n, p, o, e in [*checks, ("overall", every, failed, 0)]
    ]
    return raw.select(F.inline(F.array(*rows)))


def report_document(report: DataFrame, found: Sequence[str], expected: Sequence[str], summary: DataFrame) -> DataFrame:
    """The whole report as one row: verdict, missing and extra columns, every check, the summary figures."""
    header = header_check(found, expected)
    lines = F.sort_array(F.collect_list(F.struct("check_name", "passed", "observed", "expected")))
    one = report.agg(
        F.bool_and("passed").alias("passed"),
        F.lit(",".join(header["missing"])).alias("missing_columns"),
        F.lit(",".join(header["extra"])).alias("extra_columns"),
        lines.alias("checks"),
    )
    figures = summary.agg(F.first(F.struct("*")).alias("summary")).scalar()
    return one.withColumn("summary", figures)


def record_summary(
    df: DataFrame, key: str, required: Sequence[str], status: str, amount: str,
    active: str = "active", inactive: str = "inactive",
) -> DataFrame:
    """Rows, distinct keys, duplicates, rows with a critical NULL, status and amount figures.

    Grouping by key first gives the distinct count without a second shuffle.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    a = F.col(amount).cast("decimal(18,2)")
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(missing).alias("missing"),
        F.count_if(F.col(status) == active).alias("act"),
        F.count_if(F.col(status) == inactive).alias("inact"),
        F.sum(a).alias("s"),
        F.count(a).alias("c"),
        F.max(a).alias("hi"),
        F.min(a).alias("lo"),
    )
    return per_key.agg(
        F.sum("n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_ids"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_rows"),
        F.sum("missing").alias("critical_null_rows"),
        F.sum("act").alias("active_count"),
        F.sum("inact").alias("inactive_count"),
        F.round(F.try_divide(F.sum("s").cast("double"), F.sum("c")), 2).alias("avg_amount"),
        F.max("hi").cast("double").alias("max_amount"),
        F.min("lo").cast("double").alias("min_amount"),
    )


def gate_checks(df: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """(check_name, observed, passed) for leftover duplicates and NULLs."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(_missing(required)).alias("m"))
    row = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("duplicate_rows"),
        F.coalesce(F.sum("m"), F.lit(0).cast("long")).alias("null_rows"),
    )
    out = _melt(row, ["duplicate_rows", "null_rows"], "check_name", "observed")
    return out.withColumn("passed", F.col("observed") == 0)


def _missing(required: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return missing


def observed_gate(
    df: DataFrame, keys: Sequence[str], required: Sequence[str], write: Callable[[DataFrame, Callable[[], None]], object]
) -> DataFrame:
    """`gate_checks` taken while `write` stores the rows; returns the checks, all passed.

    `write(rows, gate)` stores `rows`, calls `gate` and makes them visible only if that does not raise, as
    `snapshots.publish` does.  Rows of a key are numbered where they lie together already, so a frame that
    comes out of a window or aggregate on the keys is not dealt again, and as nothing is dealt behind the
    checks a task that runs twice counts once.
    """
    seen, place = Observation(), Window.partitionBy(*keys).orderBy(*keys)
    numbered = df.withColumn("_place", F.row_number().over(place))
    checks = {"duplicate_rows": F.count_if(F.col("_place") > 1), "null_rows": F.count_if(_missing(required))}
    watched = numbered.observe(seen, *[c.alias(n) for n, c in checks.items()]).drop("_place")
    result = []

    def gate() -> None:
        found = metrics(seen, lambda: dict.fromkeys(checks, 0))  # nothing seen: no rows
        rows = [(n, found[n], found[n] == 0) for n in checks]
        _require([(name, n) for name, n, passed in rows if not passed])
        result.append(df.sparkSession.createDataFrame(rows, "check_name string, observed long, passed boolean"))

    write(watched, gate)
    return result[0]


def require(checks: DataFrame) -> None:
    """Raise if any row of a check table has passed = false (an action on a few rows)."""
    _require([(r["check_name"], r["observed"]) for r in checks.where(~F.col("passed")).collect()])


def _require(failed: Sequence[tuple[str, object]]) -> None:
    if failed:
        raise QualityError("; ".join(f"{name}: {observed}" for name, observed in failed))


# --- rules with quarantine --------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """What a table's definition would enforce, as data.

    checks: name -> condition; NULL passes, as a CHECK constraint lets it.
    unique: name -> (columns, order); only the first row of a value is accepted, the other columns
    deciding where `order` ties; of rows equal throughout one is accepted.
    foreign: child column -> (parent, parent key); a NULL child key passes.
    """

    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    unique: Mapping[str, tuple[Sequence[str], Sequence[str]]] = field(default_factory=dict)
    foreign: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Add `reasons`: the names of the broken rules, empty for an accepted row."""
    tests: list[Column] = []
    out = df
    if rules.unique:
        # Exact copies meet map-side and come back numbered, so that all but one can be rejected.
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        out = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_n")
    for c in rules.not_null:
        tests.append(F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")))
    for name, cond in rules.checks.items():
        tests.append(F.when(~cond, F.lit(f"check:{name}")))
    for i, (name, (cols, order)) in enumerate(rules.unique.items()):
        # First row per value by aggregate, joined back on the value; a window would
        # gather every copy of a hot value in one task.
        rest = [c for c in df.columns if c not in order and c not in cols]
        place = F.struct(*order, *rest)
        first = (
            df.groupBy(*cols)
            .agg(F.min(place).alias(f"_first{i}"))
            .select(*[F.col(c).alias(f"_u{i}_{c}") for c in cols], f"_first{i}")
        )
        on = F.lit(True)
        for c in cols:
            on = on & (F.col(c) == F.col(f"_u{i}_{c}"))
        out = out.join(first, on, "left")
        again = (place > F.col(f"_first{i}")) | ((F.col("_copy") > 1) & F.col(f"_first{i}").isNotNull())
        tests.append(F.when(again, F.lit(f"unique:{name}")))
    for i, (child, (parent, key)) in enumerate(rules.foreign.items()):
        known = parent.select(F.col(key).alias(f"_p{i}")).distinct()
        out = out.join(known, F.col(child) == F.col(f"_p{i}"), "left")
        tests.append(
            F.when(F.col(child).isNotNull() & F.col(f"_p{i}").isNull(), F.lit(f"foreign:{child}"))
        )
    return out.select(*df.columns, F.array_compact(F.array(*tests)).alias("reasons"))


def split_rules(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    tagged = apply_rules(df, rules)
    return (
        tagged.where(F.size("reasons") == 0).drop("reasons"),
        tagged.where(F.size("reasons") > 0),
    )
