import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import cleaning as C
from millrace.operators import quality as Q
from millrace.plans import care, chains


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0], [4.0, 1.0, 10.0, 2.0], [5.0], [7.0] * 9 + [1.0], [None, 2.0]])
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert C.exact_median(df, "v").first()[0] == statistics.median([v for v in values if v is not None])


def test_median_per_group_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0), ("c", None)], "k string, v double")
    assert rows(C.exact_median(df, "v", ["k"]), "k", "median") == [("a", 1.5), ("b", 9.0)]


def test_first_and_latest(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), ("b", 5, "w")], "k string, o int, v string"
    )
    assert rows(C.first_per_key(df, ["k"], [("o", False)]), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(C.first_per_key(df, ["k"], [("o", True)]), "k", "v") == [("a", "x"), ("b", "w")]
    assert rows(C.latest_per_key(df, ["k"], "o"), "k", "o", "v") == [("a", 2, "x"), ("b", 5, "w")]
    once = C.latest_per_key(df, ["k"], "o")
    assert rows(C.latest_per_key(once, ["k"], "o"), *df.columns) == rows(once, *df.columns)


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    plan = C.latest_per_key(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_semi_and_anti_make_the_whole(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "i int, p int")
    parent = spark.createDataFrame([(10,), (11,)], "key int")
    on = {"p": "key"}
    assert rows(C.keep_known(child, parent, on), "i") == [(1,)]
    assert rows(C.orphans(child, parent, on), "i") == [(2,), (3,)]


def test_repair_keeps_null(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "2024-01-01"), ("2024-01-05", None), ("2024-01-05", "2024-01-09")], "a string, b string"
    ).select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    got = [str(r.b) for r in C.repair_order(df, "a", "b").collect()]
    assert got == ["2024-01-05", "None", "2024-01-09"]


def test_noise_repeats(spark):
    df = spark.range(1000).select("id", F.lit("ICU").alias("dep"), F.lit("x").alias("v"))
    one = C.inject_variants(C.inject_nulls(df, ["v"], "id", 10, 1), "dep", {"ICU": ["icu", "Icu"]}, "id", 20, 2)
    two = C.inject_variants(C.inject_nulls(df, ["v"], "id", 10, 1), "dep", {"ICU": ["icu", "Icu"]}, "id", 20, 2)
    assert rows(one, "id", "dep", "v") == rows(two, "id", "dep", "v")
    assert one.where("v is null").count() == 100
    assert one.where("dep != 'ICU'").count() == 200


CUSTOMER = "customer_id string, name string, email string, city string, country string, signup_date string, age string, gender string, loyalty_points string"


def test_clean_customers(spark):
    raw = spark.createDataFrame(
        [
            ("1", "Ann", "a@x", "Rome", "IT", "2021-01-07 00:00:00", "18", "F", "5"),
            ("1", "Ann", "a@x", "Rome", "IT", "2021-01-07 00:00:00", "18", "F", "5"),
            ("2", "Bob", "a@x", "Oslo", "NO", "2021-01-08", "30", "M", "1"),
            ("3", "Cid", "c@x", None, None, "bad", "101", None, None),
            ("4", "Dee", "d@x", None, None, "bad", "100", None, None),
            ("5", "Eve", "e@x", "Bonn", "DE", None, "x", "F", "7"),
            ("6", None, "f@x", "Bonn", "DE", None, "40", "F", "7"),
            ("x", "Gus", "g@x", "Bonn", "DE", None, "40", "M", "7"),
            ("7", "Hal", "h@x", "Bonn", "DE", None, "17", "M", "7"),
        ],
        CUSTOMER,
    )
    got = chains.clean_customers(raw)
    assert rows(got, "customer_id", "age", "city", "gender", "loyalty_points") == [
        (1, 18.0, "Rome", "F", 5),
        (4, 100.0, "Unknown", "Unknown", 0),
        (5, None, "Bonn", "F", 7),
    ]
    assert [str(r.signup_date) for r in got.orderBy("customer_id").collect()] == ["2021-01-07", "None", "None"]


def test_clean_products_takes_the_median_after_bad_prices_left(spark):
    raw = spark.createDataFrame(
        [("1", "a", None, "10", "1", "7", "2020-01-01"), ("2", "b", "X", "-1", "1", "7", None), ("3", "c", "X", None, None, "S-1", None),
         ("4", "d", "X", "20", "2", None, None), ("5", "e", "X", "0", "2", "7", None), ("6", None, "X", "9", "2", "7", None)],
        "product_id string, name string, category string, price string, stock_qty string, supplier_id string, created_at string",
    )
    got = chains.clean_products(raw)
    assert rows(got, "product_id", "price", "category", "stock_qty", "supplier_id") == [
        (1, 10.0, "Uncategorised", 1, 7), (3, 15.0, "X", 0, None), (4, 20.0, "X", 2, None)
    ]


def test_clean_orders_and_items(spark):
    customers = spark.createDataFrame([(1,)], "customer_id long")
    orders = spark.createDataFrame(
        [
            ("1", "1", "2024-01-05", "2024-01-01", None, "10", None, None),
            ("2", "1", "2024-01-05", None, "shipped", None, "card", "Rome"),
            ("3", "9", "2024-01-05", None, "shipped", "1", "card", "Rome"),
            ("4", "1", "2025-01-05", None, "shipped", "1", "card", "Rome"),
            ("5", "1", None, None, "shipped", "1", "card", "Rome"),
            ("6", "1", "2024-01-05", None, "shipped", "-1", "card", "Rome"),
        ],
        "order_id string, customer_id string, order_date string, ship_date string, status string, "
        "total_amount string, payment_method string, shipping_city string",
    )
    clean = chains.clean_orders(orders, customers, "2024-06-30")
    got = clean.select("order_id", F.col("ship_date").cast("string").alias("ship_date"), "status", "total_amount")
    assert rows(got, "*") == [(1, "2024-01-05", "unknown", 10.0), (2, None, "shipped", 0.0)]

    items = spark.createDataFrame(
        [
            ("1", "1", "7", "2", "5", "-0.1"), ("2", "1", "7", None, None, "1.5"), ("3", "2", "7", "1", "7", None),
            ("4", "9", "7", "1", "7", "0"), ("5", "1", "8", "1", "7", "0"), ("6", "1", "7", "-1", "7", "0"),
            ("7", "1", "7", "1", "0", "0"),
        ],
        "item_id string, order_id string, product_id string, quantity string, unit_price string, discount string",
    )
    products = spark.createDataFrame([(7,)], "product_id long")
    got = chains.clean_order_items(items, clean, products)
    assert rows(got, "item_id", "quantity", "unit_price", "discount") == [
        (1, 2, 5.0, 0.0), (2, 1, 6.0, 1.0), (3, 1, 7.0, 0.0)
    ]


def test_enriched_admissions(spark):
    patients = spark.createDataFrame(
        [(1, "Ann", 61, "F", None, 1), (1, "Old", 20, "F", "9", 2), (2, None, None, "M", "8", 1)],
        "patient_id long, name string, age int, gender string, contact string, row_id int",
    )
    diagnoses = spark.createDataFrame(
        [(10, "I10", "Heart", 1), (11, "E11", "Sugar", 1), (11, "E11", "Twin", 2)],
        "diagnosis_id long, icd_code string, category string, row_id int",
    )
    admissions = spark.createDataFrame(
        [
            (100, 1, 10, " ICU", None, "2024-01-01", "2024-01-03", 99, 1, 1),
            (101, 1, 11, "ortho", "Dr. X", "2024-01-01", "2024-01-09", None, None, 1),
            (102, 2, 10, "Spa", "Dr. X", "2024-02-01", None, None, 0, 1),
            (102, 2, 11, "Spa", "Dr. Y", "2024-02-01", None, None, 0, 2),
            (103, 9, 10, "icu", "Dr. X", "2024-02-01", None, None, 1, 1),
            (104, 1, 99, "icu", "Dr. X", "2024-02-01", None, None, 1, 1),
        ],
        "admission_id long, patient_id long, diagnosis_id long, department string, physician string, "
        "admission_date string, discharge_date string, length_of_stay int, readmitted_within_30_days int, row_id int",
    ).withColumns({c: F.to_date(c) for c in ("admission_date", "discharge_date")})
    order = {t: [("row_id", False)] for t in ("patients", "diagnoses", "admissions")}
    silver = care.enrich(patients, diagnoses, admissions, order)
    assert silver.columns == care.SILVER_COLUMNS
    got = silver.select(
        "admission_id", "department", "physician", "length_of_stay", "readmission_flag", "name", "contact", "category",
        "age_group", "admission_month", "los_bucket", "comorbidity_index", "prior_admission_count",
    )
    assert rows(got, "*") == [
        (100, "ICU", "Unassigned", 2, 1, "Ann", "Unknown", "Heart", "60+", "2024-01", "Short", 2, 0),
        (101, "Orthopedics", "Dr. X", 8, 0, "Ann", "Unknown", "Sugar", "60+", "2024-01", "Long", 2, 1),
        (102, "Spa", "Dr. X", None, 0, "Unknown", "8", "Heart", "60+", "2024-02", "Long", 1, 0),
    ]
    risk = care.patient_risk(silver)
    assert rows(risk, "patient_id", "total_readmissions", "risk_category", "risk_rank") == [
        (1, 1, "Medium", 1), (2, 0, "Low", 2)
    ]


def test_report_and_gate(spark):
    df = spark.createDataFrame(
        [("1", "2.5", "1"), ("2", "n/a", "0"), ("3", " ", "x"), ("4", None, "")], "`Row ID` string, Sales string, Quantity string"
    )
    report = Q.validation_report(df, ["Row ID", "Sales", "Quantity", "Profit"], 3, ["Sales", "Quantity"], ["Quantity"], 10)
    assert rows(report, "check_name", "passed", "observed") == sorted(
        [("file_exists", True, 1), ("file_not_empty", True, 1), ("column_headers", False, 3), ("row_count", True, 4), ("null_values", False, 3),
         ("numeric_integrity", False, 5), ("overall", False, 3)], key=str,
    )
    assert Q.header_check(["a", "x"], ["a", "b"]) == {
        "passed": False, "found": 2, "expected": 2, "missing": ["b"], "extra": ["x"]
    }
    keyed = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    with pytest.raises(Q.QualityError, match="duplicate_rows: 1; null_rows: 1"):
        Q.require(Q.gate_checks(keyed, ["k"], ["v"]))
    Q.require(Q.gate_checks(keyed.where("v = 'a'"), ["k"], ["v"]))


def test_rules_name_every_reason(spark):
    parents = spark.createDataFrame([(1,)], "id int")
    batch = spark.createDataFrame(
        [(1, "a@x", 5, 1), (2, "a@x", -50, 1), (3, None, 5, 999), (4, "b@x", None, None)],
        "id int, email string, price int, parent int",
    )
    rules = Q.Rules(
        not_null=["email"], checks={"price": F.col("price") > 0},
        unique={"email": (["email"], ["id"])}, foreign={"parent": (parents, "id")},
    )
    good, bad = Q.split_rules(batch, rules)
    assert rows(good, "id") == [(1,), (4,)]
    assert rows(bad, "id", "reasons") == [
        (2, ["check:price", "unique:email"]), (3, ["not_null:email", "foreign:parent"])
    ]


def test_region_revenue_deals_the_lines_once(spark, sf):
    """Distinct lines are found where the join by order left them, even if no side is broadcast."""
    from millrace.catalog import QUERIES

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["clean_region_revenue"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("sales#" in line or "product_id#" in line for line in dealt)
