"""Storage layouts by their plans: what is moved, what is opened; and the operators beside them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.catalog.registry import in_namespace
from millrace.operators import relational as R
from millrace.plans import commerce
from millrace.session import scratch_dir
from millrace.sources import layout, tables


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large to send around."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def scans(node, out):
    """File scans of an executed plan, those of its stages included."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan(), out)
    if name.endswith("QueryStageExec"):
        return scans(node.plan(), out)
    if name == "FileSourceScanExec":
        out.append(node)
    children = node.children().iterator()
    while children.hasNext():
        scans(children.next(), out)
    return out


def folders_read(df):
    """Folders each partitioned scan of `df` opens."""
    df.collect()
    found = scans(df._jdf.queryExecution().executedPlan(), [])
    return [n.metrics().apply("numPartitions").value() for n in found if n.metrics().contains("numPartitions")]


@pytest.mark.parametrize("plan", [lambda s: commerce.revenue_by_city_and_category(s, ("P",)), commerce.lines_with_product, commerce.monthly_revenue])
def test_buckets_join_without_moving_facts(spark, sf, no_broadcast, plan):
    plain = tables.star(spark, sf)

    def work(name, path):
        s = layout.bucketed_star(plain, name, path, 8)
        df = plan(s)
        assert "Exchange hashpartitioning(order_id" not in plan_of(df)
        assert "Exchange hashpartitioning(order_id" in plan_of(plan(plain))
        return rows(df)

    assert in_namespace(spark, "buckets", work) == rows(plan(plain))


def test_bucketed_files_are_one_per_bucket(spark, sf):
    def work(name, path):
        s = layout.bucketed_star(tables.star(spark, sf), name, path, 8)
        return [len(t.inputFiles()) for t in (s.orders, s.items)]

    assert in_namespace(spark, "buckets", work) == [8, 8]
    assert layout.bucket_count(spark.range(1000), rows=100, least=3) == 16 and layout.bucket_count(spark.range(0)) == 8


def monthly(spark, sf):
    orders = tables.orders(spark, sf)
    late = orders.limit(3).select(*[F.lit(None).cast("date").alias(c) if c == "order_date" else c for c in orders.columns])
    return layout.write_monthly(orders.unionByName(late), "order_date", scratch_dir(spark, "monthly"))


def test_a_year_opens_its_folders_only(spark, sf):
    stored = monthly(spark, sf)
    months = stored.select(layout.MONTH).distinct().count()
    year = stored.where(layout.stored_in_year("order_date", 1998))
    assert folders_read(year) == [12] and months > 60
    assert year.count() == tables.orders(spark, sf).where(F.year("order_date") == 1998).count()
    assert stored.count() == tables.orders(spark, sf).count() + 3  # rows without a date have a folder


def test_a_calendar_prunes_while_the_query_runs(spark, sf):
    stored = monthly(spark, sf)
    path = scratch_dir(spark, "calendar")
    layout.months_of(stored).write.parquet(path)
    calendar = spark.read.parquet(path)
    third = layout.in_months(stored, calendar.where("quarter = 3")).select("order_id", "order_date")
    assert "dynamicpruning" in plan_of(third).lower()
    read = folders_read(third)
    assert max(read) == calendar.where("quarter = 3").count() < calendar.count() / 3
    assert third.count() == tables.orders(spark, sf).where("quarter(order_date) = 3").count()


def test_band_join_against_all_pairs(spark):
    left = [(k, d, f"l{k}{d}") for k in (1, 2, None) for d in (-70, -31, -1, 0, 1, 14, 15, 30, 44, 45, 46, 100, None)]
    right = [(k, c, f"r{k}{c}") for k in (1, 2, 3, None) for c in (-60, -16, -15, 0, 1, 30, None)]
    a = spark.createDataFrame(left, "k long, d long, l string")
    b = spark.createDataFrame(right, "k long, c long, r string")
    for low, high in ((15, 45), (-3, 3), (0, 0), (-40, -20)):
        got = [tuple(r) for r in R.band_join(a, b, ["k"], "d", "c", low, high).select("l", "r").collect()]
        want = [(x, y) for k, d, x in left for j, c, y in right if None not in (k, d, j, c) and k == j and low <= d - c <= high]
        assert Counter(got) == Counter(want)
    with pytest.raises(ValueError):
        R.band_join(a, b, ["k"], "d", "c", 3, 2)


def test_one_key_with_all_rows_is_dealt_over_many_tasks(spark, no_broadcast):
    left = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 2000).alias("d"))
    right = spark.range(40).select(F.lit(1).alias("k"), (F.col("id") * 50).alias("c"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = R.band_join(left, right, ["k"], "d", "c", 0, 9)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in tasks) == 20_000 * 40 * 10 // 2000
        assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_wide_crosstab(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", "y y"), (None, "x")], "r string, c string")
    wide = R.pivot_counts(df, "r", "c")
    assert wide.columns == ["r", "none", "x", "y y"]
    assert rows(wide) == sorted(map(str, spark.createDataFrame([("a", 1, 2, 0), ("b", 0, 0, 1), (None, 0, 1, 0)], "r string, none long, x long, `y y` long").collect()))
    with pytest.raises(ValueError, match="more than 2"):
        R.pivot_counts(df, "r", "c", most=2)
    with pytest.raises(ValueError, match="is a label"):
        R.pivot_counts(df, "r", "c", null_label="x")
    assert R.pivot_counts(df.limit(0), "r", "c").columns == ["r"]


def test_sketches_unite_and_err_little(spark):
    days = "date_add(date'2020-01-01', cast(id % 400 AS int))"
    orders = spark.range(60_000).selectExpr("id AS order_id", "id * 7919 % 23011 AS customer_id", f"{days} AS order_date", "'F' AS status", "id AS amount")
    s = tables.Star(None, None, orders, None)
    sketches = commerce.customer_sketches(s, ("P",))
    assert sketches.count() == 14 and sketches.select(F.max(F.length("customers"))).first()[0] < 10_000
    total = commerce.approximate_customers(sketches, F.lit(1).alias("all")).first()["customers"]
    assert total == pytest.approx(23_011, rel=0.05)
