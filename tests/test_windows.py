import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import windows as W


def skewed(spark, n=3000):
    """A third of the rows under one key, a third of all values equal, some NULL."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("id"),
        F.when(i % 3 == 0, 0).otherwise(i % 97).cast("long").alias("k"),
        F.when(i % 3 == 1, 5).when(i % 50 == 0, None).otherwise(F.pmod(i * 7919, F.lit(1000)))
        .cast("long").alias("v"),
        F.date_add(F.lit("2020-01-01"), (i % 40).cast("int")).alias("d"),
    )


def rows(df, *cols):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


ORDERS = [
    [("v", False), ("id", False)],
    [("v", True), ("id", False)],
    [("d", True), ("v", False), ("id", True)],
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_row_numbers_equal_the_plain_window(spark, order, keys):
    df = skewed(spark)
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*W.sort_columns(order)))
    got = W.row_numbers(df, order, keys, "rn", splits=16)
    assert rows(got, "id", "rn") == rows(df.withColumn("rn", plain), "id", "rn")


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ranks_equal_the_plain_window(spark, desc, keys):
    df, order = skewed(spark), [("v", desc)]
    w = Window.partitionBy(*keys).orderBy(*W.sort_columns(order))
    plain = df.select(
        "*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d2"), F.percent_rank().over(w).alias("p")
    )
    got = W.ranks(df, order, keys, "r", "d2", "p", splits=8)
    assert rows(got, "id", "r", "d2", "p") == rows(plain, "id", "r", "d2", "p")


@pytest.mark.parametrize("tiles", [1, 3, 4, 7])
def test_ntiles_equal_the_plain_window(spark, tiles):
    df = skewed(spark, 1001)
    plain = F.ntile(tiles).over(Window.orderBy(*W.sort_columns([("v", False), ("id", False)])))
    got = W.ntiles(df, tiles, [("v", False), ("id", False)], out="t", splits=8)
    assert rows(got, "id", "t") == rows(df.withColumn("t", plain), "id", "t")


def test_more_tiles_than_rows(spark):
    df = spark.range(3)
    assert rows(W.ntiles(df, 5, [("id", False)], out="t", splits=4), "id", "t") == [
        ("0", "1"), ("1", "2"), ("2", "3")
    ]


def test_running_total_peers_share(spark):
    df = skewed(spark).where("v is not null")
    plain = F.sum("v").over(Window.partitionBy("k").orderBy("d"))
    got = W.running_range_total(df, [("d", False)], F.col("v"), "t", ["k"], splits=8)
    assert rows(got, "id", "t") == rows(df.withColumn("t", plain), "id", "t")
    whole = W.running_by_period(df, "d", F.sum("v"), "t")
    plain = F.sum("v").over(Window.orderBy("d"))
    assert rows(whole, "id", "t") == rows(df.withColumn("t", plain), "id", "t")


def test_running_total_ends_at_the_sum(spark):
    df = skewed(spark).fillna({"v": 0})
    run = W.prefix_sums(df, [("d", False), ("id", False)], {"t": F.col("v")}, splits=8)
    assert run.agg(F.max("t")).first()[0] == df.agg(F.sum("v")).first()[0]


def test_prior_count_breaks_ties_by_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "2024-01-01"), (2, 1, "2024-01-01"), (3, 1, "2024-02-01"), (4, 2, "2024-01-01")],
        "id long, k long, d string",
    ).withColumn("d", F.to_date("d"))
    got = W.prior_counts(df, [("d", False), ("id", False)], ["k"], "prior")
    assert rows(got, "id", "prior") == [("1", "0"), ("2", "1"), ("3", "2"), ("4", "0")]


def test_distinct_per_key_counts_no_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, None)], "k long, v string")
    assert rows(W.distinct_per_key(df, ["k"], "v", "n"), "k", "n") == [
        ("1", "2"), ("1", "2"), ("1", "2"), ("2", "0")
    ]


def test_empty_input(spark):
    df = spark.range(0)
    assert W.row_numbers(df, [("id", False)]).count() == 0
    assert W.ranks(df, [("id", False)], rank="r").count() == 0


def test_a_hot_group_is_cut(spark):
    """No range holds more than a small part of the rows, and small groups are not cut up."""
    df = skewed(spark, 6000)
    cut = W.with_range(df, [("v", False), ("id", False)], ["k"], 32)
    assert cut.groupBy("_range").count().agg(F.max("count")).first()[0] < 6000 / 10
    assert cut.select("k", "_range").distinct().count() < 97 + 2 * 32


def odd_values(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("id"),
        F.when(i % 11 == 0, F.lit(float("nan"))).when(i % 7 == 0, None).when(i % 5 == 0, float("-inf"))
        .otherwise((i * 37 % 101).cast("double") - 50).alias("x"),
        F.when(i % 9 == 0, None).otherwise(i % 2 == 0).alias("b"),
        F.when(i % 8 == 0, None).otherwise(F.concat(F.lit("t"), (i * 31 % 200).cast("string"))).alias("t"),
        F.when(i % 6 == 0, None).otherwise(F.date_add(F.lit("2020-01-01"), (i * 13 % 300).cast("int"))).alias("d"),
    )


@pytest.mark.parametrize("column", ["x", "b", "t", "d"])
@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("keys", [[], ["b"]])
def test_null_and_nan_stand_where_spark_puts_them(spark, column, desc, keys):
    df, order = odd_values(spark), [(column, desc), ("id", False)]
    w = Window.partitionBy(*keys).orderBy(*W.sort_columns(order))
    got = W.row_numbers(df, order, keys, "rn", splits=8)
    assert rows(got, "id", "rn") == rows(df.withColumn("rn", F.row_number().over(w)), "id", "rn")
    w = Window.partitionBy(*keys).orderBy(*W.sort_columns(order[:1]))
    got = W.ranks(df, order[:1], keys, "r", "dr", splits=8)
    plain = df.select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"))
    assert rows(got, "id", "r", "dr") == rows(plain, "id", "r", "dr")


def test_descending_text_is_cut(spark):
    cut = W.with_range(odd_values(spark), [("t", True), ("id", False)], splits=8)
    assert cut.select("_range").distinct().count() == 8


def test_more_rows_make_more_ranges(spark, monkeypatch):
    monkeypatch.setattr(W, "ROWS_PER_RANGE", 100)
    assert W._ranges(spark.range(2500), None) == 25


def test_rows_never_gather_in_one_task(spark):
    df = skewed(spark)
    plan = W.row_numbers(df, [("v", False), ("id", False)], splits=8)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    # What meets in one task are the totals, one row per range.
    assert all("HashAggregate" in part.splitlines()[1] for part in text.split("SinglePartition")[1:])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-3, 3)), min_size=1, max_size=30))
def test_any_rows(spark, pairs):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(pairs)], "id long, k long, v long")
    got = W.ranks(df, [("v", True)], ["k"], rank="r", splits=4)
    plain = F.rank().over(Window.partitionBy("k").orderBy(F.desc("v")))
    assert rows(got, "id", "r") == rows(df.withColumn("r", plain), "id", "r")


def test_the_enriched_rows_meet_patients_and_their_index_in_one_join(spark, sf):
    from millrace.catalog import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["silver_enriched"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "patient_id" in line]
    assert dealt and not any("coalesce(patient_id" in line and "_range" not in line and "_r#" not in line for line in dealt)


@pytest.mark.parametrize("limit", [15, 500, 10**6])
def test_only_large_groups_are_cut(spark, monkeypatch, limit):
    """Prior counts with NULL keys and a hot one, whichever groups are dealt whole; both ways are joined on."""
    df = skewed(spark).withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    order, cut = [("v", True), ("id", False)], []
    plain = F.row_number().over(Window.partitionBy("k").orderBy(*W.sort_columns(order))) - 1
    numbered = W.row_numbers
    monkeypatch.setattr(W, "ROWS_PER_RANGE", limit)
    monkeypatch.setattr(W, "row_numbers", lambda rows, *a: cut.append(rows) or numbered(rows, *a))
    names = spark.range(60).selectExpr("id AS k", "id * 2 AS twice")
    got = W.prior_counts(df, order, ["k"], "prior", attach=lambda rows: rows.join(names, "k", "left"))
    want = df.withColumn("prior", plain).join(names, "k", "left")
    assert rows(got, "id", "k", "v", "prior", "twice") == rows(want, "id", "k", "v", "prior", "twice")
    sizes = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}
    large = {k for k, n in sizes.items() if n > limit}
    assert len(cut) == bool(large) and all(large <= {r["k"] for r in c.select("k").distinct().collect()} for c in cut)
    if limit == 500:  # one group, and what shares its bucket at most
        assert len(large) == 1 and cut[0].select("k").distinct().count() < 5


def wide_admissions(spark, n=400):
    i = F.col("id")
    day = F.date_add(F.lit("2024-01-01"), (i * 7 % 90).cast("int"))
    return spark.range(n).select(
        (i % 350).alias("admission_id"), F.when(i % 3 == 0, 1).when(i % 41 != 0, i % 23).alias("patient_id"),
        F.when(i % 37 != 0, i % 19).alias("diagnosis_id"), F.lit(" ICU").alias("department"),
        F.when(i % 5 != 0, F.concat(F.lit("Dr. "), (i % 9).cast("string"))).alias("physician"), day.alias("admission_date"),
        F.date_add(day, (i % 11).cast("int")).alias("discharge_date"), F.lit(1).alias("length_of_stay"),
        (i % 2).cast("int").alias("readmitted_within_30_days"), i.alias("row_id"),
    )


def enriched(spark):
    from millrace.plans import care

    person = spark.range(40).selectExpr(
        "if(id = 30, null, id % 20) AS patient_id", "if(id % 4 = 0, null, concat('p', id)) AS name", "cast(id * 3 AS int) AS age",
        "'F' AS gender", "cast(null AS string) AS contact", "id AS row_id",
    )
    code = spark.range(25).selectExpr("id % 15 AS diagnosis_id", "concat('I', id) AS icd_code", "if(id = 3, null, 'c') AS category", "id AS row_id")
    order = {t: [("row_id", False)] for t in ("patients", "diagnoses", "admissions")}
    return lambda *columns: care.enrich(person, code, wide_admissions(spark), order, columns or care.SILVER_COLUMNS)


def test_enriched_rows_are_the_same_however_patients_are_dealt(spark, monkeypatch):
    silver = enriched(spark)
    whole = rows(silver(), "*")
    assert len(whole) > 200
    monkeypatch.setattr(W, "ROWS_PER_RANGE", 30)
    assert rows(silver(), "*") == whole
    some = ["admission_id", "prior_admission_count", "comorbidity_index", "icd_code"]
    known = rows(silver(*some), *some)
    monkeypatch.setattr(W, "ROWS_PER_RANGE", 10**6)
    assert rows(silver(*some), *some) == known == rows(silver(), *some)


def test_valid_admissions_are_dealt_once_more(spark):
    """To their patients, where they are counted too; diagnoses are attached before they are stored."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enriched(spark)()._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    dealt = 0
    for i, line in enumerate(plan):
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        dealt += "Exchange" in line and any("FileScan" in x and "physician" in x for x in plan[i:below])
    assert dealt == 1
