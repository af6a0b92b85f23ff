"""Counts and gates taken in the job that writes."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.operators import quality as Q
from millrace.operators.cleaning import drop_duplicate_rows, latest_per_key
from millrace.session import scratch_dir
from millrace.sources import snapshots

SCHEMA = "k long, t string, v long"
STEPS = [("unique", drop_duplicate_rows), ("named", lambda d: d.where("t IS NOT NULL")), ("latest", lambda d: latest_per_key(d, ["k"], "v", ["t"]))]


def frame(spark, n=50):
    rows = [(i % 20, None if i % 7 == 0 else f"t{i % 30}", i % 10) for i in range(n)]
    return spark.createDataFrame([*rows, *rows], SCHEMA)


def jobs_of(spark, work):
    """How many jobs with tasks that `work` starts."""
    context, group = spark.sparkContext, f"group-{os.urandom(4).hex()}"
    context.setLocalProperty("spark.jobGroup.id", group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("n", [50, 1, 0])
def test_steps_are_counted_while_the_result_is_written(spark, n):
    root, raw = scratch_dir(spark, "steps"), frame(spark, n)
    got = [tuple(r) for r in Q.step_counts(raw, STEPS, lambda df: snapshots.publish(df, root, "CLEAN")).collect()]
    frames = [raw]
    for _, step in STEPS:
        frames.append(step(frames[-1]))
    left = [f.count() for f in frames]
    assert got == [(i, name, left[i], left[max(i - 1, 0)] - left[i]) for i, name in enumerate(["raw", "unique", "named", "latest"])]
    assert snapshots.read(spark, root).count() == left[-1]


def test_steps_are_counted_apart_where_tasks_ran_again(spark, monkeypatch):
    root, raw = scratch_dir(spark, "steps"), frame(spark)
    want = Q.step_counts(raw, STEPS, lambda df: snapshots.publish(df, root, "CLEAN")).collect()
    monkeypatch.setattr(Q._Watched, "ran_again", lambda self: True)
    assert Q.step_counts(raw, STEPS, lambda df: snapshots.publish(df, root, "AGAIN")).collect() == want


def test_the_writing_job_is_watched(spark):
    """A task that fails once is seen; the counts are right all the same."""
    folder = scratch_dir(spark, "flaky")
    os.makedirs(folder)

    def flaky(batches):
        import os as o

        yield from batches
        try:
            o.mkdir(f"{folder}/failed")
        except FileExistsError:
            return
        raise RuntimeError("once")

    with Q._Watched(spark) as jobs:
        snapshots.publish(frame(spark), scratch_dir(spark, "calm"), "CLEAN")
    assert not jobs.ran_again() and spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
    with Q._Watched(spark) as jobs:
        try:
            snapshots.publish(frame(spark).mapInArrow(flaky, SCHEMA), scratch_dir(spark, "flaky"), "CLEAN")
        except Exception:
            pass  # a local session does not try a task again
    assert jobs.ran_again()


def test_no_copy_is_staged_for_the_counts(spark, sf, monkeypatch):
    import millrace.plans.chains as chains

    monkeypatch.setattr(chains, "staged", lambda *a: pytest.fail("staged"))
    assert QUERIES["dq_stage_counts"](spark, sf).count() == 5


def write_to(root):
    return lambda rows, gate: snapshots.publish(rows, root, "CLEAN", gate=gate)


def test_a_gate_that_holds_commits(spark):
    root, clean = scratch_dir(spark, "gate"), latest_per_key(frame(spark).where("t IS NOT NULL"), ["k"], "v", ["t"])
    checks = Q.observed_gate(clean, ["k"], ["k", "t"], write_to(root))
    assert [tuple(r) for r in checks.collect()] == [("duplicate_rows", 0, True), ("null_rows", 0, True)]
    assert snapshots.read(spark, root).columns == ["k", "t", "v"] and snapshots.read(spark, root).count() == clean.count()
    assert sorted(map(tuple, checks.collect())) == sorted(map(tuple, Q.gate_checks(clean, ["k"], ["k", "t"]).collect()))


def test_a_gate_that_fails_leaves_no_version(spark):
    root, raw = scratch_dir(spark, "gate"), frame(spark)
    snapshots.publish(raw.limit(3), root, "WRITE")
    with pytest.raises(Q.QualityError, match="duplicate_rows: 80; null_rows: 16"):
        Q.observed_gate(raw, ["k"], ["t"], write_to(root))
    assert [r["version"] for r in snapshots.history(spark, root).collect()] == [0]
    assert os.listdir(root) and not os.path.exists(f"{root}/v=1")
    checks = {r["check_name"]: r["observed"] for r in Q.gate_checks(raw, ["k"], ["t"]).collect()}
    assert checks == {"duplicate_rows": 80, "null_rows": 16}


def test_the_gate_adds_no_exchange(spark):
    plans = []
    rows = latest_per_key(frame(spark), ["k"], "v", ["t"])

    def write(watched, gate):
        plans.append(watched._jdf.queryExecution().executedPlan().toString())
        snapshots.publish(watched, scratch_dir(spark, "gate"), "CLEAN", gate=lambda: None)
        gate()

    Q.observed_gate(rows, ["k"], ["k"], write)
    assert plans[0].count("Exchange") == rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_gated_publish_is_one_job_besides_the_commit(spark):
    root, clean = scratch_dir(spark, "gate"), frame(spark).where(F.col("t").isNotNull()).dropDuplicates(["k"])
    plain = jobs_of(spark, lambda: snapshots.publish(clean, f"{root}/a", "WRITE"))
    assert jobs_of(spark, lambda: Q.observed_gate(clean, ["k"], ["t"], write_to(f"{root}/b"))) <= plain
