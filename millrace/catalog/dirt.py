"""Raw tables with quality faults, derived from the test tables by rules both engines repeat.

Each relation is one SELECT that Spark and DuckDB read alike; the faults are decided by
the row's key.  Exact duplicates come from the data: a customer export with one row per
order, a product export with one row per sold line, orders and returned lines sent twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.tables import load

RAW_CUSTOMERS = """SELECT
    CASE WHEN c_custkey % 53 = 0 THEN 'n/a' ELSE CAST(c_custkey AS STRING) END AS customer_id,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS name,
    CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE concat('c', CAST(c_custkey
        - CASE WHEN c_custkey % 11 = 1 THEN 1 ELSE 0 END AS STRING), '@shop.example') END AS email,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS city,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE concat('N', CAST(c_nationkey AS STRING)) END AS country,
    CASE WHEN c_custkey % 23 = 0 THEN 'not a date' WHEN c_custkey % 29 = 0 THEN '2021-13-40'
        ELSE concat('202', CAST(c_nationkey % 5 AS STRING), '-0', CAST(c_nationkey % 9 + 1 AS STRING),
        '-1', CAST(c_custkey % 10 AS STRING), ' 00:00:00') END AS signup_date,
    CASE WHEN c_custkey % 43 = 0 THEN 'x' WHEN c_custkey % 7 = 0 THEN NULL
        ELSE CAST(c_nationkey * 5 AS STRING) END AS age,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(c_custkey % 1000 AS STRING) END AS loyalty_points
    FROM {orders} JOIN {customer} ON c_custkey = o_custkey"""

RAW_PRODUCTS = """SELECT
    CASE WHEN p_partkey % 61 = 0 THEN '?' ELSE CAST(p_partkey AS STRING) END AS product_id,
    CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN concat('"', p_name, '", or', chr(10), 'so')
        ELSE p_name END AS name,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS category,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN 'n/a'
        WHEN p_partkey % 29 = 0 THEN '-1' WHEN p_partkey % 31 = 0 THEN '0'
        ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END AS price,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS STRING) END AS stock_qty,
    CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN 'S-1'
        ELSE CAST(p_partkey % 100 AS STRING) END AS supplier_id,
    CASE WHEN p_partkey % 41 = 0 THEN 'someday' ELSE concat('2020-01-1', CAST(p_partkey % 10 AS STRING)) END
        AS created_at
    FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"""

_ORDER = """
    CASE WHEN o_orderkey % 71 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS STRING) END AS order_id,
    CASE WHEN o_orderkey % 29 = 0 THEN CAST(-o_custkey - 1 AS STRING) WHEN o_orderkey % 41 = 0 THEN NULL
        ELSE CAST(o_custkey AS STRING) END AS customer_id,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN 'unknown'
        ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 00:00:00') END AS order_date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
        ELSE concat(CAST(1996 + o_orderkey % 5 AS STRING), '-07-1', CAST(o_orderkey % 10 AS STRING)) END AS ship_date,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'n/a' WHEN o_orderkey % 59 = 0 THEN '-5'
        ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS total_amount,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS payment_method,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('City ', CAST(o_custkey % 40 AS STRING)) END AS shipping_city
    FROM {orders}"""
RAW_ORDERS = f"SELECT {_ORDER} UNION ALL SELECT {_ORDER} WHERE o_orderstatus = 'P'"

_ITEM = """
    CASE WHEN l_suppkey % 89 = 0 THEN 'n/a' ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END AS item_id,
    CASE WHEN l_partkey % 53 = 0 THEN '-1' ELSE CAST(l_orderkey AS STRING) END AS order_id,
    CASE WHEN l_orderkey % 59 = 0 THEN CAST(-l_partkey - 1 AS STRING) WHEN l_orderkey % 61 = 0 THEN NULL
        ELSE CAST(l_partkey AS STRING) END AS product_id,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 23 = 0 THEN 'x' WHEN l_orderkey % 29 = 0 THEN '-2'
        ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS quantity,
    CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN '0'
        ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS unit_price,
    CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN '1.5' WHEN l_orderkey % 43 = 0 THEN '-0.1'
        ELSE CAST(abs(CAST(l_discount AS DECIMAL(4,2))) AS STRING) END AS discount
    FROM {lineitem}"""
RAW_ITEMS = f"SELECT {_ITEM} UNION ALL SELECT {_ITEM} WHERE l_returnflag = 'R'"

# A product catalogue with price text; row_id is the position in the file.
RAW_CATALOGUE = """SELECT p_partkey AS row_id,
    concat('P', CAST(p_partkey - CASE WHEN p_partkey % 9 = 1 THEN 1 ELSE 0 END AS STRING)) AS product_id,
    p_name AS title,
    CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10 END AS rating,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS ratings_count,
    CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size % 20 AS BIGINT) END AS discount,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS seller_name,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'fine' END AS what_customers_said,
    CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_type END AS product_description,
    CASE WHEN p_partkey % 23 = 0 THEN 'price on request' WHEN p_partkey % 29 = 0 THEN NULL
        ELSE concat('"₹', CAST(p_size AS STRING), ',', substr(CAST(1000 + p_partkey % 1000 AS STRING), 2, 3), '.',
        CAST(10 + p_partkey % 90 AS STRING), ' "') END AS final_price
    FROM {part}"""

# Care tables: a customer is a patient, a product a diagnosis, a sold line an admission.
RAW_PATIENTS = """SELECT c_custkey AS patient_id,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS name,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 5 + c_nationkey * 3 END AS age,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('9', CAST(c_custkey AS STRING)) END AS contact,
    o_orderkey AS row_id
    FROM {orders} JOIN {customer} ON c_custkey = o_custkey"""

RAW_DIAGNOSES = """SELECT p_partkey AS diagnosis_id, p_brand AS icd_code, p_type AS category, 1 AS row_id FROM {part}
    UNION ALL SELECT p_partkey, p_brand, p_type, 2 FROM {part} WHERE p_type = 'PROMO'"""

RAW_ADMISSIONS = """SELECT l_orderkey * 10 + l_linenumber AS admission_id,
    CASE WHEN o_orderkey % 29 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS patient_id,
    CASE WHEN l_suppkey % 31 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS diagnosis_id,
    CASE o_orderpriority
        WHEN '1-URGENT' THEN CASE l_linenumber % 3 WHEN 0 THEN 'icu' WHEN 1 THEN ' ICU ' ELSE 'ICU' END
        WHEN '2-HIGH' THEN CASE l_linenumber % 3 WHEN 0 THEN 'cardio' WHEN 1 THEN 'CARDIOLOGY' ELSE 'Cardiology' END
        WHEN '3-MEDIUM' THEN CASE l_linenumber % 3 WHEN 0 THEN 'Gen. Medicine' WHEN 1 THEN 'gen medicine'
            ELSE 'General Medicine' END
        WHEN '4-NOT SPECIFIED' THEN CASE l_linenumber % 2 WHEN 0 THEN 'Onco' ELSE 'Oncology' END
        ELSE 'Dermatology' END AS department,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE concat('Dr. ', CAST(l_suppkey AS STRING)) END AS physician,
    CAST(o_orderdate AS DATE) AS admission_date,
    CASE WHEN l_suppkey % 37 = 0 THEN NULL
        ELSE CAST(CAST(o_orderdate AS DATE) + (CAST(l_quantity AS INTEGER) % 12) * INTERVAL '1' DAY AS DATE) END
        AS discharge_date,
    CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 1 END AS length_of_stay,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS readmitted_within_30_days,
    CAST(l_shipdate AS DATE) AS ship_date, l_partkey AS part_id, l_suppkey AS supplier_id,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price
    FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey"""

_TABLES = ("customer", "supplier", "part", "orders", "lineitem")


def frame(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    """The relation as a DataFrame."""
    used = {t: load(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in select}
    return spark.sql(select, **used)


def text(select: str) -> str:
    """The relation as a DuckDB sub-select."""
    return select.format(**{t: t for t in _TABLES})
