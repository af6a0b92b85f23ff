"""Profiles, checks, cleaning steps and chains on tables with derived faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import dirt
from millrace.catalog.registry import big, mean, money, query, star
from millrace.functions import exprs as X
from millrace.operators import cleaning as C
from millrace.operators import quality as Q
from millrace.plans import care, chains, superstore
from millrace.session import scratch_dir
from millrace.sources import files, sinks, snapshots, tables
from millrace.sources.schemas import SALES_FILE_COLUMNS, SALES_FILE_MIN_ROWS, SALES_FILE_NUMERIC

AS_OF = "2000-01-01"


def raw(*names: str) -> str:
    """CTEs raw_<name> for a DuckDB statement."""
    return ", ".join(f"raw_{n} AS ({dirt.text(getattr(dirt, 'RAW_' + n.upper()))})" for n in names)


def _raw(spark, sf, name):
    return dirt.frame(spark, sf, getattr(dirt, f"RAW_{name.upper()}"))


# Products, one row per key, with holes; the input of the single-step queries.
_HOLED = """, h AS (SELECT product_id, CASE WHEN product_id % 7 = 0 THEN NULL ELSE name END AS name,
    CASE WHEN product_id % 5 = 0 THEN NULL ELSE price END AS price,
    CASE WHEN product_id % 11 = 0 THEN NULL ELSE stock END AS stock, category FROM prod)"""


def _holed(spark, sf):
    hole = lambda c, n: F.when(F.col("product_id") % n != 0, F.col(c)).alias(c)
    return tables.products(spark, sf).select(
        "product_id", hole("name", 7), hole("price", 5), hole("stock", 11), "category"
    )


# --- steps ------------------------------------------------------------------------


@query(
    "dq_fill_const",
    star(f"""{_HOLED} SELECT product_id, coalesce(name, 'Unknown') AS name, CAST(coalesce(price, 0) AS DOUBLE) AS price,
        coalesce(stock, 0) AS stock, category FROM h"""),
)
def dq_fill_const(spark, sf):
    filled = C.fill_const(_holed(spark, sf), {"name": "Unknown", "price": 0, "stock": 0})
    return filled.withColumn("price", F.col("price").cast("double"))


@query(
    "dq_fill_median",
    star(f"""{_HOLED} SELECT product_id, round(coalesce(CAST(price AS DOUBLE),
        (SELECT median(CAST(price AS DOUBLE)) FROM h)), 4) AS price FROM h"""),
)
def dq_fill_median(spark, sf):
    prices = _holed(spark, sf).select("product_id", F.col("price").cast("double").alias("price"))
    return C.fill_median(prices, "price").withColumn("price", F.round("price", 4))


@query(
    "dq_drop_null",
    star(f"""{_HOLED} SELECT product_id, name, stock FROM h WHERE name IS NOT NULL AND stock IS NOT NULL"""),
)
def dq_drop_null(spark, sf):
    return C.drop_null(_holed(spark, sf).select("product_id", "name", "stock"), ["name", "stock"])


@query("dq_dedup_row", f"WITH {raw('customers')} SELECT DISTINCT * FROM raw_customers")
def dq_dedup_row(spark, sf):
    return C.drop_duplicate_rows(_raw(spark, sf, "customers"))


_LINE = "order_id, line_number, product_id, supplier_id, quantity, ship_date, CAST(gross AS DOUBLE) AS gross"


def _lines(spark, sf):
    return tables.items(spark, sf).select(
        "order_id", "line_number", "product_id", "supplier_id", "quantity", "ship_date",
        F.col("gross").cast("double").alias("gross"),
    )


@query(
    "dq_dedup_key",
    star(f"""SELECT * FROM (SELECT {_LINE} FROM item) QUALIFY row_number() OVER (PARTITION BY order_id, line_number
        ORDER BY product_id, supplier_id, quantity, ship_date, gross) = 1"""),
)
def dq_dedup_key(spark, sf):
    order = [(c, False) for c in ("product_id", "supplier_id", "quantity", "ship_date", "gross")]
    return C.first_per_key(_lines(spark, sf), ["order_id", "line_number"], order)


@query(
    "dq_keep_latest",
    star(f"""SELECT * FROM (SELECT {_LINE} FROM item) QUALIFY row_number() OVER (PARTITION BY order_id, line_number
        ORDER BY ship_date DESC, product_id DESC, supplier_id DESC, quantity DESC, gross DESC) = 1"""),
)
def dq_keep_latest(spark, sf):
    return C.latest_per_key(
        _lines(spark, sf), ["order_id", "line_number"], "ship_date",
        ["product_id", "supplier_id", "quantity", "gross"],
    )


_PRICE = """TRY_CAST(trim(replace(replace(replace(final_price, '₹', ''), ',', ''), '"', '')) AS DECIMAL(12,2))"""


@query(
    "dq_parse_currency",
    f"""WITH {raw('catalogue')} SELECT row_id, CAST({_PRICE} AS DOUBLE) AS price FROM raw_catalogue""",
)
def dq_parse_currency(spark, sf):
    return _raw(spark, sf, "catalogue").select(
        "row_id", X.parse_currency("final_price").cast("double").alias("price")
    )


@query(
    "dq_range_check",
    star(f"""{_HOLED} SELECT product_id, CAST(price AS DOUBLE) AS price, stock FROM h
        WHERE (price IS NULL OR price > 940) AND (stock IS NULL OR stock BETWEEN 10 AND 40)"""),
)
def dq_range_check(spark, sf):
    kept = C.keep_in_range(_holed(spark, sf), "price", F.col("price") > 940)
    kept = C.keep_in_range(kept, "stock", F.col("stock").between(10, 40))
    return kept.select("product_id", F.col("price").cast("double").alias("price"), "stock")


_RATE = "CASE WHEN order_id % 37 = 0 THEN NULL WHEN order_id % 41 = 0 THEN 1.5 WHEN order_id % 43 = 0 THEN -0.1 ELSE CAST(discount AS DOUBLE) END"


@query(
    "dq_clip",
    star(f"""SELECT order_id, line_number, abs(CASE WHEN r IS NULL THEN 0 ELSE least(greatest(r, 0), 1) END) AS discount
        FROM (SELECT order_id, line_number, CAST({_RATE} AS DOUBLE) AS r FROM item)"""),
)
def dq_clip(spark, sf):
    rates = tables.items(spark, sf).select(
        "order_id", "line_number", F.expr(f"CAST({_RATE} AS DOUBLE)").alias("r")
    )
    return rates.select("order_id", "line_number", F.abs(X.clip("r", 0.0, 1.0, 0.0)).alias("discount"))


_DATED = """, d AS (SELECT i.order_id, i.line_number, i.product_id, o.order_date, CASE WHEN i.product_id % 13 = 0 THEN NULL
    ELSE i.ship_date END AS ship_date FROM item i JOIN ord o ON o.order_id = i.order_id)"""


def _dated(spark, sf):
    s = tables.star(spark, sf)
    return s.items.join(s.orders.select("order_id", "order_date"), "order_id").select(
        "order_id", "line_number", "product_id", "order_date",
        F.when(F.col("product_id") % 13 != 0, F.col("ship_date")).alias("ship_date"),
    )


@query(
    "dq_repair_dates",
    star(f"""{_DATED} SELECT order_id, line_number, product_id, order_date, CASE WHEN ship_date < order_date
        THEN order_date ELSE ship_date END AS ship_date FROM d"""),
)
def dq_repair_dates(spark, sf):
    return C.repair_order(_dated(spark, sf), "order_date", "ship_date")


_ORPHANED = """, c AS (SELECT order_id, line_number, CASE WHEN order_id % 29 = 0 THEN -product_id - 1
    WHEN order_id % 31 = 0 THEN NULL ELSE product_id END AS product_id FROM item)"""


def _orphaned(spark, sf):
    k = F.col("order_id")
    return tables.items(spark, sf).select(
        "order_id", "line_number",
        F.when(k % 29 == 0, -F.col("product_id") - 1)
        .when(k % 31 == 0, F.lit(None))
        .otherwise(F.col("product_id"))
        .alias("product_id"),
    )


@query(
    "dq_orphan_filter",
    star(f"{_ORPHANED} SELECT * FROM c WHERE product_id IN (SELECT product_id FROM prod)"),
)
def dq_orphan_filter(spark, sf):
    return C.keep_known(_orphaned(spark, sf), tables.products(spark, sf), "product_id")


@query(
    "dq_orphan_report",
    star(f"""{_ORPHANED} SELECT count(*) AS orphan_rows, count(DISTINCT product_id) AS orphan_keys FROM c
        WHERE product_id IS NULL OR product_id NOT IN (SELECT product_id FROM prod)"""),
)
def dq_orphan_report(spark, sf):
    lost = C.orphans(_orphaned(spark, sf), tables.products(spark, sf), "product_id")
    return lost.agg(
        F.count(F.lit(1)).alias("orphan_rows"), F.countDistinct("product_id").alias("orphan_keys")
    )


def _canon(col: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in care.DEPARTMENTS.items())
    return f"CASE lower(trim({col})) {arms} ELSE {col} END"


@query(
    "dq_canonicalise",
    f"""WITH {raw('admissions')} SELECT {_canon('department')} AS department, count(*) AS admissions
        FROM raw_admissions GROUP BY 1""",
)
def dq_canonicalise(spark, sf):
    fixed = _raw(spark, sf, "admissions").select(X.canonical("department", care.DEPARTMENTS).alias("department"))
    return fixed.groupBy("department").agg(F.count(F.lit(1)).alias("admissions"))


# --- profiles ---------------------------------------------------------------------


def _null_rows(table: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM {table}" for c in cols
    )


_CUSTOMER_COLS = "customer_id name email city country signup_date age gender loyalty_points".split()


@query(
    "dq_null_profile",
    f"""WITH {raw('customers')}, n AS ({_null_rows('raw_customers', _CUSTOMER_COLS)})
        SELECT * FROM n WHERE null_count > 0""",
)
def dq_null_profile(spark, sf):
    return Q.null_profile(_raw(spark, sf, "customers"), only_present=True)


@query(
    "dq_dup_profile",
    star("""SELECT count(*) AS total_rows, count(DISTINCT (order_id, line_number)) AS distinct_keys,
        count(*) - count(DISTINCT (order_id, line_number)) AS duplicate_rows,
        CASE WHEN count(*) = count(DISTINCT (order_id, line_number)) THEN 'PASS' ELSE 'FAIL' END AS status FROM item"""),
)
def dq_dup_profile(spark, sf):
    return Q.duplicate_profile(tables.items(spark, sf), ["order_id", "line_number"])


@query(
    "dq_dup_values",
    f"""WITH {raw('customers')} SELECT email, count(*) AS cnt FROM raw_customers GROUP BY email HAVING count(*) > 1""",
)
def dq_dup_values(spark, sf):
    return Q.duplicate_values(_raw(spark, sf, "customers"), ["email"])


@query(
    "dq_shape",
    """SELECT (SELECT count(*) FROM supplier) AS row_count, 4 AS column_count, * FROM (VALUES (1, 's_suppkey', 'bigint'),
        (2, 's_name', 'string'), (3, 's_nationkey', 'int'), (4, 's_acctbal', 'double'))
        t(position, column_name, data_type)""",
)
def dq_shape(spark, sf):
    return Q.shape(tables.load(spark, sf, "supplier"))


_CONTRACT = ["product_id", "name", "category", "price", "stock_qty", "supplier_id"]


@query(
    "dq_header_check",
    f"""WITH {raw('products')} SELECT count(*) AS row_count, false AS passed, CAST(6 AS BIGINT) AS found,
        CAST(6 AS BIGINT) AS expected, 'supplier_id' AS missing, 'created_at' AS extra FROM raw_products""",
)
def dq_header_check(spark, sf):
    return Q.header_check_rows(_raw(spark, sf, "products").drop("supplier_id"), _CONTRACT)


@query("dq_min_rows", "SELECT count(*) AS observed, count(*) >= 9000 AS passed FROM orders")
def dq_min_rows(spark, sf):
    n = F.count(F.lit(1))
    return tables.load(spark, sf, "orders").agg(n.alias("observed"), (n >= 9000).alias("passed"))


def _blank_count(cols) -> str:
    return " + ".join(f"count(*) FILTER ({c} IS NULL OR trim({c}) = '')" for c in cols)


@query(
    "dq_empty_cells",
    f"WITH {raw('customers')} SELECT {_blank_count(_CUSTOMER_COLS)} AS empty_cells FROM raw_customers",
)
def dq_empty_cells(spark, sf):
    return _raw(spark, sf, "customers").agg(Q.empty_cells(_raw(spark, sf, "customers")).alias("empty_cells"))


def _bad_numbers(plain, positive) -> str:
    value = "CASE WHEN {c} IS NULL OR {c} = '' THEN 0 ELSE TRY_CAST(trim({c}) AS DOUBLE) END"
    terms = [f"count(*) FILTER (({value.format(c=c)}) IS NULL)" for c in plain]
    terms += [f"count(*) FILTER (({value.format(c=c)}) IS NULL OR ({value.format(c=c)}) <= 0)" for c in positive]
    return " + ".join(terms)


@query(
    "dq_numeric_check",
    f"WITH {raw('items')} SELECT {_bad_numbers(['unit_price', 'discount'], ['quantity'])} AS numeric_errors FROM raw_items",
)
def dq_numeric_check(spark, sf):
    return _raw(spark, sf, "items").agg(
        Q.numeric_errors(["unit_price", "quantity", "discount"], ["quantity"]).alias("numeric_errors")
    )


# --- the sales file -----------------------------------------------------------


# The 21-column sales file made from the star, as text with faults.
_FILE_EXPRS = {
    "Row ID": "CAST(order_id * 10 + line_number AS STRING)",
    "Order ID": "CAST(order_id AS STRING)",
    "Order Date": "CAST(order_date AS STRING)",
    "Ship Date": "CAST(ship_date AS STRING)",
    "Ship Mode": "CASE WHEN order_id % 17 = 0 THEN NULL ELSE payment_method END",
    "Customer ID": "CAST(customer_id AS STRING)",
    "Customer Name": "cust_name",
    "Segment": "city",
    "Country": "CAST(country AS STRING)",
    "City": "CASE WHEN order_id % 19 = 0 THEN ' ' ELSE city END",
    "State": "CAST(country AS STRING)",
    "Postal Code": "CAST(customer_id % 100 AS STRING)",
    "Region": "return_flag",
    "Product ID": "CAST(product_id AS STRING)",
    "Category": "category",
    "Sub-Category": "brand",
    "Product Name": """CASE WHEN product_id % 7 = 0 THEN concat(prod_name, ', "new"', chr(10), '2nd line') ELSE prod_name END""",
    "Sales": "CASE WHEN order_id % 23 = 0 THEN 'n/a' ELSE CAST(CAST(revenue AS DECIMAL(18,4)) AS STRING) END",
    "Quantity": "CASE WHEN order_id % 29 = 0 THEN '0' ELSE CAST(quantity AS STRING) END",
    "Discount": "CAST(discount AS STRING)",
    "Profit": "CAST(gross AS STRING)",
}


def sales_file(spark, sf):
    """All sold lines in the layout of the sales file, every column text.

    Customers meet the orders and products the lines before the two meet, so lines are dealt twice, and only
    once with other tables' columns; revenue, made of two columns of a line, is made behind the joins.
    """
    s = tables.star(spark, sf)
    bought = s.orders.join(s.customers.withColumnRenamed("name", "cust_name"), "customer_id")
    goods = s.products.select("product_id", F.col("name").alias("prod_name"), "category", "brand")
    wide = s.items.drop("revenue").join(goods, "product_id").join(bought, "order_id")
    wide = wide.withColumn("revenue", X.line_revenue("gross", "discount"))
    return wide.select(*[F.expr(e).alias(n) for n, e in _FILE_EXPRS.items()])


SALES_FILE_SQL = ", wide AS (SELECT i.*, o.order_date, o.payment_method, o.customer_id, c.name AS cust_name, c.city, c.country, p.name AS prod_name, p.category, p.brand FROM item i JOIN ord o ON o.order_id = i.order_id JOIN cust c ON c.customer_id = o.customer_id JOIN prod p ON p.product_id = i.product_id), file AS (SELECT {} FROM wide)".format(
    ", ".join(f'{e} AS "{n}"' for n, e in _FILE_EXPRS.items())
)

_QUOTED = [f'"{c}"' for c in SALES_FILE_COLUMNS]

_LENIENT = "CASE WHEN {0} IS NULL OR trim({0}) = '' THEN 0 ELSE TRY_CAST(trim({0}) AS DECIMAL(18,4)) END"
SUMMARY_SQL = f"""SELECT count(*) AS total_rows, {money('sum(sales)')} AS total_sales, {mean('sum(sales)', 'count(sales)')} AS avg_sales,
    {money('max(sales)')} AS max_sales, {money('min(sales)')} AS min_sales, {money('sum(profit)')} AS total_profit,
    {mean('sum(profit)', 'count(profit)')} AS avg_profit
    FROM (SELECT {_LENIENT.format('"Sales"')} AS sales, {_LENIENT.format('"Profit"')} AS profit FROM file)"""


@query("dq_summary_stats", star(f"{SALES_FILE_SQL} {SUMMARY_SQL}"))
def dq_summary_stats(spark, sf):
    """Over the text file: some sales are no number."""
    return Q.summary_stats(sales_file(spark, sf), "Sales", "Profit")


def sales_csv(spark, sf):
    """(the file as text columns, its size) after a round trip through the store, where it is kept compressed."""
    path = scratch_dir(spark, "sales-file")
    sinks.write_csv(sales_file(spark, sf), path, "gzip")
    return files.read_csv_strings(spark, path), files.size_bytes(spark, path)


# Blank cells become NULL in the file, which counts alike.
REPORT_SQL = f"""m AS (SELECT count(*) AS n, {_blank_count(_QUOTED)} AS blank,
        {_bad_numbers(['"Sales"', '"Profit"', '"Discount"'], ['"Quantity"'])} AS bad FROM file),
    report AS (SELECT 'file_exists' AS check_name, true AS passed, CAST(1 AS BIGINT) AS observed, CAST(1 AS BIGINT) AS expected FROM m
        UNION ALL SELECT 'file_not_empty', true, 1, 1 FROM m
        UNION ALL SELECT 'column_headers', true, 21, 21 FROM m
        UNION ALL SELECT 'row_count', n >= {SALES_FILE_MIN_ROWS}, n, {SALES_FILE_MIN_ROWS} FROM m
        UNION ALL SELECT 'null_values', blank = 0, blank, 0 FROM m
        UNION ALL SELECT 'numeric_integrity', bad = 0, bad, 0 FROM m
        UNION ALL SELECT 'overall', n >= {SALES_FILE_MIN_ROWS} AND blank = 0 AND bad = 0,
            CAST(n < {SALES_FILE_MIN_ROWS} AS BIGINT) + CAST(blank > 0 AS BIGINT) + CAST(bad > 0 AS BIGINT), 0 FROM m)"""


def sales_report(rows, size):
    return Q.validation_report(
        rows, SALES_FILE_COLUMNS, SALES_FILE_MIN_ROWS, SALES_FILE_NUMERIC, ["Quantity"], size
    )


@query("dq_report", star(f"{SALES_FILE_SQL}, {REPORT_SQL} SELECT * FROM report"))
def dq_report(spark, sf):
    return sales_report(*sales_csv(spark, sf))


@query(
    "dq_gate",
    star(f""", l AS (SELECT * FROM (SELECT {_LINE} FROM item) QUALIFY row_number() OVER (PARTITION BY order_id, line_number
        ORDER BY ship_date DESC, product_id DESC, supplier_id DESC, quantity DESC, gross DESC) = 1),
        m AS (SELECT count(*) - count(DISTINCT (order_id, line_number)) AS dup,
        count(*) FILTER (order_id IS NULL OR line_number IS NULL OR ship_date IS NULL) AS missing FROM l)
        SELECT 'duplicate_rows' AS check_name, dup AS observed, dup = 0 AS passed FROM m
        UNION ALL SELECT 'null_rows', missing, missing = 0 FROM m"""),
)
def dq_gate(spark, sf):
    """The latest row per line becomes a version if the gate holds, all in one job; it raises if it does not."""
    root, keys = scratch_dir(spark, "gated"), ["order_id", "line_number"]
    write = lambda rows, gate: snapshots.publish(rows, root, "CLEAN", gate=gate)
    return Q.observed_gate(dq_keep_latest(spark, sf), keys, [*keys, "ship_date"], write)


_TYPED_CUSTOMERS = """SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id, name, email, TRY_CAST(age AS DOUBLE) AS age FROM u"""


@query(
    "dq_stage_counts",
    f"""WITH {raw('customers')}, u AS (SELECT DISTINCT * FROM raw_customers), k AS (SELECT * FROM ({_TYPED_CUSTOMERS})
            WHERE customer_id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL),
        e AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id, name, age NULLS FIRST) = 1),
        c AS (SELECT 0 AS step, 'raw' AS stage, count(*) AS rows_left FROM raw_customers
            UNION ALL SELECT 1, 'unique_rows', count(*) FROM u UNION ALL SELECT 2, 'complete', count(*) FROM k
            UNION ALL SELECT 3, 'unique_email', count(*) FROM e
            UNION ALL SELECT 4, 'age_in_range', count(*) FROM e WHERE age IS NULL OR age BETWEEN 18 AND 100)
        SELECT *, coalesce(lag(rows_left) OVER (ORDER BY step) - rows_left, 0) AS rows_removed FROM c""",
)
def dq_stage_counts(spark, sf):
    """The customer chain, row duplicates and repeated e-mails included, counted while its result is stored."""
    root = scratch_dir(spark, "customers")
    return Q.step_counts(_raw(spark, sf, "customers"), chains.CUSTOMER_STEPS, lambda df: snapshots.publish(df, root, "CLEAN"))


# --- rules -----------------------------------------------------------------------------

# Every fiftieth order arrives twice, exactly alike.
_BATCH = """, b0 AS (SELECT order_id, CASE WHEN order_id % 37 = 0 THEN NULL WHEN order_id % 29 = 0 THEN -customer_id - 1
    ELSE customer_id END AS customer_id, CASE WHEN order_id % 41 = 0 THEN 'X' ELSE status END AS status,
    CASE WHEN order_id % 43 = 0 THEN -amount ELSE amount END AS amount,
    concat('R-', CAST(order_id - CASE WHEN order_id % 11 = 1 THEN 1 ELSE 0 END AS STRING)) AS reference FROM ord),
    b AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE order_id % 50 = 0)"""


def _batch(spark, sf):
    k = F.col("order_id")
    rows = tables.orders(spark, sf).select(
        "order_id",
        F.when(k % 37 == 0, F.lit(None)).when(k % 29 == 0, -F.col("customer_id") - 1)
        .otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(k % 41 == 0, "X").otherwise(F.col("status")).alias("status"),
        F.when(k % 43 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.concat(F.lit("R-"), (k - F.when(k % 11 == 1, 1).otherwise(0)).cast("string")).alias("reference"),
    )
    return rows.unionByName(rows.where(k % 50 == 0))


@query(
    "dq_constraints",
    star(f"""{_BATCH} SELECT order_id, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'not_null:customer_id' END,
        CASE WHEN status NOT IN ('F', 'O', 'P') THEN 'check:status' END, CASE WHEN amount < 0 THEN 'check:amount' END,
        CASE WHEN row_number() OVER (PARTITION BY reference ORDER BY order_id) > 1 THEN 'unique:reference' END,
        CASE WHEN customer_id NOT IN (SELECT customer_id FROM cust) THEN 'foreign:customer_id' END) AS reasons
        FROM b"""),
)
def dq_constraints(spark, sf):
    """Accepted rows have no reasons, rejected ones name every broken rule."""
    rules = Q.Rules(
        not_null=["customer_id"],
        checks={"status": F.col("status").isin("F", "O", "P"), "amount": F.col("amount") >= 0},
        unique={"reference": (["reference"], ["order_id"])},
        foreign={"customer_id": (tables.customers(spark, sf), "customer_id")},
    )
    tagged = Q.apply_rules(_batch(spark, sf), rules)
    return tagged.select("order_id", F.concat_ws(",", "reasons").alias("reasons"))


@query(
    "dq_table_counts",
    """SELECT 'customers' AS tbl, count(*) AS row_count FROM customer UNION ALL SELECT 'products', count(*) FROM part
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'order_items', count(*) FROM lineitem""",
)
def dq_table_counts(spark, sf):
    s = tables.star(spark, sf)
    return Q.table_counts(
        {"customers": s.customers, "products": s.products, "orders": s.orders, "order_items": s.items}
    )


@query(
    "dq_validation_report",
    star(f"""{_BATCH} SELECT count(*) AS total_rows, count(DISTINCT reference) AS distinct_ids,
        count(*) - count(DISTINCT reference) AS duplicate_rows, count(*) FILTER (customer_id IS NULL) AS critical_null_rows,
        count(*) FILTER (status = 'F') AS active_count, count(*) FILTER (status = 'O') AS inactive_count,
        {mean('sum(amount)', 'count(amount)')} AS avg_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
        CAST(min(amount) AS DOUBLE) AS min_amount FROM b"""),
)
def dq_validation_report(spark, sf):
    return Q.record_summary(
        _batch(spark, sf), "reference", ["customer_id", "reference"], "status", "amount", "F", "O"
    )


_VARIANTS = {"F": ["f", "Fin", "FINISHED"], "O": ["o", "Open"]}


@query(
    "dq_inject_noise",
    star("""SELECT order_id, CASE WHEN (order_id * 37 + 3) % 100 < 10 THEN NULL ELSE payment_method END AS payment_method,
        CASE WHEN (order_id * 37 + 7) % 100 < 20 AND status = 'F' THEN ['f', 'Fin', 'FINISHED'][order_id % 3 + 1]
            WHEN (order_id * 37 + 7) % 100 < 20 AND status = 'O' THEN ['o', 'Open'][order_id % 2 + 1] ELSE status END AS status,
        CASE WHEN (order_id * 37 + 5) % 100 < 2 THEN order_date + CAST(order_id % 7 - 3 AS INTEGER)
            ELSE order_date END AS order_date FROM ord"""),
)
def dq_inject_noise(spark, sf):
    rows = tables.orders(spark, sf).select("order_id", "payment_method", "status", "order_date")
    noisy = C.inject_nulls(rows, ["payment_method"], "order_id", 10, 3)
    noisy = C.inject_variants(noisy, "status", _VARIANTS, "order_id", 20, 7)
    return C.inject_date_jitter(noisy, "order_date", "order_id", 3, 2, 5)


# --- chains ---------------------------------------------------------------------------------

_CLEAN_CUSTOMERS = f"""{raw('customers')}, tc AS (SELECT DISTINCT * FROM raw_customers),
    clean_customers AS (SELECT customer_id, name, email, coalesce(city, 'Unknown') AS city,
        coalesce(country, 'Unknown') AS country, signup_date, age, coalesce(gender, 'Unknown') AS gender,
        coalesce(loyalty_points, 0) AS loyalty_points FROM (SELECT * FROM (SELECT TRY_CAST(customer_id AS BIGINT) AS customer_id,
        name, email, city, country, CAST(TRY_CAST(signup_date AS TIMESTAMP) AS DATE) AS signup_date,
        TRY_CAST(age AS DOUBLE) AS age, gender, TRY_CAST(loyalty_points AS BIGINT) AS loyalty_points FROM tc)
        WHERE customer_id IS NOT NULL AND name IS NOT NULL AND email IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id, name NULLS FIRST, city NULLS FIRST,
            country NULLS FIRST, signup_date NULLS FIRST, age NULLS FIRST, gender NULLS FIRST, loyalty_points NULLS FIRST) = 1)
        WHERE age IS NULL OR age BETWEEN 18 AND 100)"""

_CLEAN_PRODUCTS = f"""{raw('products')}, tp AS (SELECT TRY_CAST(product_id AS BIGINT) AS product_id, name, category,
        TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(stock_qty AS BIGINT) AS stock_qty, TRY_CAST(supplier_id AS BIGINT) AS supplier_id,
        CAST(TRY_CAST(created_at AS TIMESTAMP) AS DATE) AS created_at FROM (SELECT DISTINCT * FROM raw_products)),
    kp AS (SELECT * FROM tp WHERE product_id IS NOT NULL AND name IS NOT NULL AND (price IS NULL OR price > 0)),
    clean_products AS (SELECT product_id, name, coalesce(category, 'Uncategorised') AS category,
        round(coalesce(price, (SELECT median(price) FROM kp)), 4) AS price, coalesce(stock_qty, 0) AS stock_qty, supplier_id, created_at FROM kp)"""

_CLEAN_ORDERS = f"""{raw('orders')}, td AS (SELECT TRY_CAST(order_id AS BIGINT) AS order_id,
        TRY_CAST(customer_id AS BIGINT) AS customer_id, CAST(TRY_CAST(order_date AS TIMESTAMP) AS DATE) AS order_date,
        CAST(TRY_CAST(ship_date AS TIMESTAMP) AS DATE) AS ship_date, status, TRY_CAST(total_amount AS DOUBLE) AS total_amount,
        payment_method, shipping_city FROM (SELECT DISTINCT * FROM raw_orders)),
    clean_orders AS (SELECT order_id, customer_id, order_date,
        CASE WHEN ship_date < order_date THEN order_date ELSE ship_date END AS ship_date,
        coalesce(status, 'unknown') AS status, coalesce(total_amount, 0) AS total_amount,
        coalesce(payment_method, 'unknown') AS payment_method, coalesce(shipping_city, 'Unknown') AS shipping_city
        FROM td WHERE order_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM clean_customers)
        AND order_date <= DATE '{AS_OF}' AND (total_amount IS NULL OR total_amount >= 0))"""

_CLEAN_ITEMS = f"""{raw('items')}, ti AS (SELECT TRY_CAST(item_id AS BIGINT) AS item_id, TRY_CAST(order_id AS BIGINT) AS order_id,
        TRY_CAST(product_id AS BIGINT) AS product_id, TRY_CAST(quantity AS BIGINT) AS quantity,
        TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(discount AS DOUBLE) AS discount
        FROM (SELECT DISTINCT * FROM raw_items)),
    ki AS (SELECT * FROM ti WHERE item_id IS NOT NULL AND order_id IN (SELECT order_id FROM clean_orders)
        AND product_id IN (SELECT product_id FROM clean_products) AND (quantity IS NULL OR quantity > 0)
        AND (unit_price IS NULL OR unit_price > 0)),
    clean_items AS (SELECT item_id, order_id, product_id, coalesce(quantity, 1) AS quantity,
        round(coalesce(unit_price, (SELECT median(unit_price) FROM ki)), 4) AS unit_price,
        CASE WHEN discount IS NULL THEN 0 ELSE least(greatest(discount, 0), 1) END AS discount FROM ki)"""


def _r4(df, col):
    return df.withColumn(col, F.round(col, 4))


@query("clean_customers", f"WITH {_CLEAN_CUSTOMERS} SELECT * FROM clean_customers")
def clean_customers(spark, sf):
    return chains.clean_customers(_raw(spark, sf, "customers"))


@query("clean_products", f"WITH {_CLEAN_PRODUCTS} SELECT * FROM clean_products")
def clean_products(spark, sf):
    return _r4(chains.clean_products(_raw(spark, sf, "products")), "price")


@query(
    "dq_repaired_dates",
    f"""WITH {_CLEAN_CUSTOMERS}, {_CLEAN_ORDERS.replace('CASE WHEN ship_date < order_date THEN order_date ELSE ship_date END', 'ship_date')}
        SELECT count(*) FILTER (ship_date < order_date) AS repaired_dates FROM clean_orders""",
)
def dq_repaired_dates(spark, sf):
    people = chains.valid_customers(_raw(spark, sf, "customers"))
    raw_orders = C.drop_duplicate_rows(_raw(spark, sf, "orders"))
    return chains.repaired_dates(chains.valid_orders(raw_orders, people, AS_OF))


@query("clean_orders", f"WITH {_CLEAN_CUSTOMERS}, {_CLEAN_ORDERS} SELECT * FROM clean_orders")
def clean_orders(spark, sf):
    people = chains.valid_customers(_raw(spark, sf, "customers"))
    return chains.clean_orders(_raw(spark, sf, "orders"), people, AS_OF)


@query(
    "clean_order_items",
    f"WITH {_CLEAN_CUSTOMERS}, {_CLEAN_PRODUCTS}, {_CLEAN_ORDERS}, {_CLEAN_ITEMS} SELECT * FROM clean_items",
)
def clean_order_items(spark, sf):
    """Orders and products are only asked for the keys that stay."""
    people = chains.valid_customers(_raw(spark, sf, "customers"))
    known_orders = chains.valid_orders(_raw(spark, sf, "orders"), people, AS_OF)
    known_products = chains.valid_products(_raw(spark, sf, "products"))
    items = chains.clean_order_items(_raw(spark, sf, "items"), known_orders, known_products)
    return _r4(items, "unit_price")


@query(
    "clean_catalogue",
    f"""WITH {raw('catalogue')}, f AS (SELECT * REPLACE (round(coalesce(rating, (SELECT median(rating) FROM raw_catalogue)), 4) AS rating,
        coalesce(ratings_count, 0) AS ratings_count, coalesce(discount, 0) AS discount, coalesce(seller_name, 'Unknown Seller') AS seller_name,
        coalesce(what_customers_said, 'No reviews') AS what_customers_said,
        coalesce(product_description, 'No description available') AS product_description) FROM raw_catalogue
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY row_id) = 1)
        SELECT *, CAST({_PRICE} AS DOUBLE) AS price, row_id % 5 + 1 AS quantity,
        CAST({_PRICE} * (row_id % 5 + 1) AS DOUBLE) AS total_amount FROM f WHERE {_PRICE} IS NOT NULL""",
)
def clean_catalogue(spark, sf):
    out = chains.clean_catalogue(_raw(spark, sf, "catalogue"), F.col("row_id") % 5 + 1)
    return _r4(out, "rating").withColumns(
        {c: F.col(c).cast("double") for c in ("price", "total_amount")}
    )


@query(
    "clean_region_revenue",
    star(f""", r AS (SELECT city AS region, CASE WHEN i.product_id % 7 = 0 THEN NULL ELSE i.revenue END AS sales, i.order_id,
        i.line_number, i.product_id, i.supplier_id FROM sold i JOIN cust c ON c.customer_id = i.customer_id),
        d AS (SELECT DISTINCT * FROM (SELECT * FROM r UNION ALL SELECT * FROM r WHERE region = 'BUILDING'))
        SELECT region, {money('sum(coalesce(sales, 0))')} AS total_revenue FROM d GROUP BY region"""),
)
def clean_region_revenue(spark, sf):
    s = tables.star(spark, sf)
    buyers = s.customers.select("customer_id", F.col("city").alias("region"))
    sold = s.orders.where("status <> 'P'").select("order_id", "customer_id").join(buyers, "customer_id")
    # Buyers meet orders first, so that the lines are dealt once, by order, and their distinct rows lie in the same tasks.
    rows = s.items.join(sold.select("order_id", "region"), "order_id").select(
        "region",
        F.when(F.col("product_id") % 7 != 0, F.col("revenue")).alias("sales"),
        "order_id", "line_number", "product_id", "supplier_id",
    )
    doubled = rows.unionByName(rows.where("region = 'BUILDING'"))
    return superstore.region_revenue(doubled, "region", "sales")
