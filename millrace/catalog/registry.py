"""Query registry and the SQL fragments the oracle statements share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure, scratch_dir
from millrace.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The test tables have order states F, O and P; P stands for an order that does not count.
EXCLUDED = ("P",)
AS_OF = "2001-09-01"


def query(key: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under `key`."""

    def add(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return add


def in_namespace(spark, label, work):
    """Run `work` with a new namespace current, step back and take the namespace away.

    Its tables lie in the scratch folder, so what `work` returns can still be read.
    """
    name = f"{label}_{uuid.uuid4().hex}"
    before, tables_at = spark.catalog.currentDatabase(), scratch_dir(spark, f"{label}-tables")
    sinks.use_namespace(spark, name, scratch_dir(spark, label))
    try:
        return work(name, tables_at)
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP SCHEMA {name} CASCADE")


# The entity tables of millrace.sources.tables, said in SQL.
_ENTITIES = """
cust AS (SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS city,
    c_nationkey AS country, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer),
prod AS (SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(12,2)) AS price, p_size AS stock FROM part),
ord AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderpriority AS payment_method FROM orders),
item AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
    l_linenumber AS line_number, CAST(l_quantity AS BIGINT) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS gross, CAST(l_discount AS DECIMAL(4,2)) AS discount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
        AS DECIMAL(18,4)) AS revenue,
    CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag FROM lineitem),
kept AS (SELECT * FROM ord WHERE status NOT IN ('P')),
sold AS (SELECT i.*, k.customer_id, k.order_date, k.payment_method, k.status
    FROM item i JOIN kept k ON k.order_id = i.order_id),
value_of AS (SELECT order_id, customer_id, order_date, payment_method, sum(revenue) AS revenue,
    sum(quantity) AS units, count(*) AS lines FROM sold
    GROUP BY order_id, customer_id, order_date, payment_method),
spend_of AS (SELECT customer_id, count(DISTINCT order_id) AS n, sum(quantity) AS units,
    sum(revenue) AS revenue, min(order_date) AS first_day, max(order_date) AS last_day
    FROM sold GROUP BY customer_id),
flat AS (SELECT i.order_id, i.line_number, i.product_id, i.supplier_id, i.quantity, i.discount,
    i.revenue AS sales, CAST(i.revenue - i.gross * CAST(0.95 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS profit,
    o.order_date, o.customer_id, c.city AS segment, p.name AS product_name, p.category,
    p.brand AS sub_category
    FROM item i JOIN ord o ON o.order_id = i.order_id JOIN cust c ON c.customer_id = o.customer_id
    JOIN prod p ON p.product_id = i.product_id),
flat_by_customer AS (SELECT customer_id, sum(sales) AS sales, sum(profit) AS profit,
    count(DISTINCT order_id) AS n FROM flat GROUP BY customer_id)
"""


def star(body: str) -> str:
    """A statement over the entity tables; `body` may start with ', name AS (...)'."""
    return f"WITH {_ENTITIES} {body}"


def money(expr: str, digits: int = 2) -> str:
    return f"CAST(round({expr}, {digits}) AS DOUBLE)"


def half_up(expr: str, digits: int) -> str:
    """Round a double half away from zero in decimal, as Spark does.

    DuckDB's own round() on doubles takes 16.685 down, because the binary value lies a
    little below it.
    """
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def mean(total: str, count: str, digits: int = 2) -> str:
    return half_up(f"CAST({total} AS DOUBLE) / CAST({count} AS DOUBLE)", digits)


def pct(part: str, whole: str) -> str:
    return half_up(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / CAST({whole} AS DOUBLE)", 2)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"
