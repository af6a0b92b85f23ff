"""Projections, predicates, joins, sub-queries, aggregates, sorting and scalar functions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from millrace.catalog.registry import AS_OF, ORACLES, big, in_namespace, mean, money, pct, query, star
from millrace.functions import exprs as X
from millrace.operators import relational as R
from millrace.operators.cleaning import exact_median, not_after
from millrace.operators.windows import row_numbers

from millrace.plans import commerce, superstore
from millrace.plans.commerce import QUARTILE_LABELS, counted
from millrace.session import scratch_dir, staged
from millrace.sources import layout, tables

# --- projections ----------------------------------------------------------------


@query("proj_all", "SELECT * FROM customer")
def proj_all(spark, sf):
    return tables.load(spark, sf, "customer")


@query("proj_cols", "SELECT c_name, c_mktsegment, c_nationkey FROM customer")
def proj_cols(spark, sf):
    return tables.load(spark, sf, "customer").select("c_name", "c_mktsegment", "c_nationkey")


@query("proj_rename", "SELECT p_partkey, p_name AS product_title, p_brand FROM part")
def proj_rename(spark, sf):
    part = tables.load(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return part.withColumnRenamed("p_name", "product_title")


@query("proj_drop", "SELECT * EXCLUDE (props) FROM events")
def proj_drop(spark, sf):
    return tables.load(spark, sf, "events").drop("props")


@query(
    "proj_compute",
    star("""SELECT product_id, CAST(price AS DOUBLE) * 1.18::DOUBLE AS final_price,
        CAST(price AS DOUBLE) / 84.0::DOUBLE AS price_in_usd,
        CAST(price * stock AS DOUBLE) AS stock_value FROM prod"""),
)
def proj_compute(spark, sf):
    price = F.col("price").cast("double")
    return tables.products(spark, sf).select(
        "product_id",
        (price * F.lit(1.18)).alias("final_price"),
        (price / F.lit(84.0)).alias("price_in_usd"),
        (F.col("price") * F.col("stock")).cast("double").alias("stock_value"),
    )


@query(
    "proj_cast",
    star("SELECT product_id, CAST(CAST(price AS VARCHAR) AS DOUBLE) AS price FROM prod"),
)
def proj_cast(spark, sf):
    text = tables.products(spark, sf).select("product_id", F.col("price").cast("string").alias("price"))
    return text.withColumn("price", F.col("price").cast("double"))


# Text with unparseable numbers, decided by the key.
_NOISY_NUMBER = "CASE WHEN product_id % 23 = 0 THEN 'n/a' WHEN product_id % 17 = 0 THEN NULL ELSE CAST(price AS STRING) END"


@query(
    "proj_try_cast",
    star(f"SELECT product_id, TRY_CAST({_NOISY_NUMBER} AS DOUBLE) AS price FROM prod"),
)
def proj_try_cast(spark, sf):
    noisy = tables.products(spark, sf).select("product_id", F.expr(_NOISY_NUMBER).alias("price"))
    return noisy.withColumn("price", X.to_number("price"))


_NOISY_DATE = """CASE WHEN order_id % 29 = 0 THEN 'unknown' WHEN order_id % 31 = 0 THEN '1999-13-40'
    WHEN order_id % 2 = 0 THEN CAST(order_date AS STRING)
    ELSE concat(CAST(order_date AS STRING), ' 00:00:00') END"""


@query(
    "proj_try_date",
    star(f"SELECT order_id, CAST(TRY_CAST({_NOISY_DATE} AS TIMESTAMP) AS DATE) AS order_date FROM ord"),
)
def proj_try_date(spark, sf):
    noisy = tables.orders(spark, sf).select("order_id", F.expr(_NOISY_DATE).alias("order_date"))
    return noisy.withColumn("order_date", X.to_day("order_date"))


@query("proj_parse_date", star("SELECT order_id, order_date FROM ord"))
def proj_parse_date(spark, sf):
    text = tables.orders(spark, sf).select(
        "order_id", F.date_format("order_date", "M/d/yyyy").alias("Order Date")
    )
    return text.withColumn("order_date", X.parse_day("Order Date")).drop("Order Date")


# --- predicates ------------------------------------------------------------------


@query("flt_eq", star("SELECT order_id, customer_id, status FROM ord WHERE status = 'F'"))
def flt_eq(spark, sf):
    return tables.orders(spark, sf).where(F.col("status") == "F").select(
        "order_id", "customer_id", "status"
    )


@query(
    "flt_and",
    star("SELECT product_id, name, category FROM prod WHERE category = 'PROMO' AND price > 950"),
)
def flt_and(spark, sf):
    return tables.products(spark, sf).where(
        (F.col("category") == "PROMO") & (F.col("price") > 950)
    ).select("product_id", "name", "category")


@query(
    "flt_or",
    star("""SELECT order_id, payment_method, status FROM ord
        WHERE payment_method = '1-URGENT' OR status = 'O'"""),
)
def flt_or(spark, sf):
    return tables.orders(spark, sf).where(
        (F.col("payment_method") == "1-URGENT") | (F.col("status") == "O")
    ).select("order_id", "payment_method", "status")


@query("flt_ne", star("SELECT order_id, status FROM ord WHERE status <> 'P'"))
def flt_ne(spark, sf):
    return tables.orders(spark, sf).where(F.col("status") != "P").select("order_id", "status")


@query(
    "flt_between",
    star("""SELECT order_id, order_date, status FROM ord
        WHERE order_date BETWEEN DATE '1998-08-10' AND DATE '1998-08-25' AND status <> 'P'"""),
)
def flt_between(spark, sf):
    low, high = F.lit("1998-08-10").cast("date"), F.lit("1998-08-25").cast("date")
    return tables.orders(spark, sf).where(
        F.col("order_date").between(low, high) & (F.col("status") != "P")
    ).select("order_id", "order_date", "status")


@query(
    "flt_in",
    star("""SELECT order_id, status, payment_method FROM ord
        WHERE payment_method IN ('1-URGENT', '2-HIGH') AND status NOT IN ('P', 'O')"""),
)
def flt_in(spark, sf):
    return tables.orders(spark, sf).where(
        F.col("payment_method").isin("1-URGENT", "2-HIGH") & ~F.col("status").isin("P", "O")
    ).select("order_id", "status", "payment_method")


_HOLED_NAME = "CASE WHEN customer_id % 17 = 0 THEN NULL ELSE name END"
_HOLED_CITY = "CASE WHEN customer_id % 13 = 0 THEN '' WHEN customer_id % 19 = 0 THEN NULL ELSE city END"


def _holed_customers(spark, sf):
    return tables.customers(spark, sf).select(
        "customer_id", F.expr(_HOLED_NAME).alias("name"), F.expr(_HOLED_CITY).alias("city"), "country"
    )


_HOLED = f""", h AS (SELECT customer_id, {_HOLED_NAME} AS name, {_HOLED_CITY} AS city, country FROM cust)"""


@query(
    "flt_null",
    star(f"""{_HOLED} SELECT count(*) FILTER (name IS NULL) AS null_names,
        count(*) FILTER (name IS NOT NULL) AS known_names FROM h"""),
)
def flt_null(spark, sf):
    return _holed_customers(spark, sf).agg(
        F.count_if(F.col("name").isNull()).alias("null_names"),
        F.count_if(F.col("name").isNotNull()).alias("known_names"),
    )


@query(
    "flt_valid_customer",
    star(f"{_HOLED} SELECT * FROM h WHERE name IS NOT NULL AND city <> ''"),
)
def flt_valid_customer(spark, sf):
    return _holed_customers(spark, sf).where(F.col("name").isNotNull() & (F.col("city") != ""))


@query(
    "flt_sargable_year",
    star("""SELECT order_id, order_date, CAST(amount AS DOUBLE) AS amount FROM ord
        WHERE year(order_date) = 1998"""),
)
def flt_sargable_year(spark, sf):
    return tables.orders(spark, sf).where(X.in_year("order_date", 1998)).select(
        "order_id", "order_date", F.col("amount").cast("double").alias("amount")
    )


@query("flt_year_partitioned", ORACLES["flt_sargable_year"])
def flt_year_partitioned(spark, sf):
    """Orders stored by month; the year's folders are the only ones opened."""
    stored = layout.write_monthly(tables.orders(spark, sf), "order_date", scratch_dir(spark, "monthly"))
    return stored.where(layout.stored_in_year("order_date", 1998)).select(
        "order_id", "order_date", F.col("amount").cast("double").alias("amount")
    )


@query(
    "com_rev_third_quarter",
    star(f"""SELECT strftime(order_date, '%Y-%m') AS year_month, count(DISTINCT order_id) AS num_orders,
        {big('sum(quantity)')} AS units_sold, {money('sum(revenue)')} AS monthly_revenue
        FROM sold WHERE quarter(order_date) = 3 GROUP BY 1"""),
)
def com_rev_third_quarter(spark, sf):
    """Orders stored by month meet a calendar; which folders it needs is found while the query runs."""
    s = tables.star(spark, sf)
    stored = layout.write_monthly(s.orders, "order_date", scratch_dir(spark, "monthly"))
    calendar = staged(layout.months_of(stored), "calendar")
    third = layout.in_months(stored, calendar.where("quarter = 3"))
    months = commerce.monthly_revenue(replace(s, orders=third), ("P",))
    return months.select(
        X.year_month("month_start").alias("year_month"), "num_orders", F.col("units").alias("units_sold"),
        X.rounded("revenue").alias("monthly_revenue"),
    )


@query(
    "flt_future",
    star("SELECT order_id, order_date FROM ord WHERE order_date <= DATE '2000-01-01'"),
)
def flt_future(spark, sf):
    return not_after(tables.orders(spark, sf), "order_date", "2000-01-01").select(
        "order_id", "order_date"
    )


@query("distinct_values", star("SELECT DISTINCT category, brand FROM prod"))
def distinct_values(spark, sf):
    return tables.products(spark, sf).select("category", "brand").distinct()


@query(
    "proj_case_tier",
    star("""SELECT product_id, CAST(price AS DOUBLE) AS price, CASE WHEN price < 930 THEN 'Budget'
        WHEN price <= 970 THEN 'Mid-Range' ELSE 'Premium' END AS price_tier FROM prod"""),
)
def proj_case_tier(spark, sf):
    return tables.products(spark, sf).select(
        "product_id",
        F.col("price").cast("double").alias("price"),
        X.price_tier("price", 930, 970).alias("price_tier"),
    )


@query(
    "proj_simple_case",
    star("""SELECT order_id, line_number, CASE line_number WHEN 1 THEN 'Q1 – Low' WHEN 2 THEN 'Q2 – Mid-Low'
        WHEN 3 THEN 'Q3 – Mid-High' WHEN 4 THEN 'Q4 – High' END AS label FROM item"""),
)
def proj_simple_case(spark, sf):
    return tables.items(spark, sf).select(
        "order_id", "line_number", X.label_of("line_number", QUARTILE_LABELS).alias("label")
    )


# --- joins -----------------------------------------------------------------------------


@query(
    "join_inner",
    star("""SELECT o.order_id, o.order_date, c.name, CAST(o.amount AS DOUBLE) AS amount
        FROM ord o JOIN cust c ON c.customer_id = o.customer_id"""),
)
def join_inner(spark, sf):
    return tables.orders(spark, sf).join(tables.customers(spark, sf), "customer_id").select(
        "order_id", "order_date", "name", F.col("amount").cast("double").alias("amount")
    )


@query(
    "join_left",
    star("""SELECT c.customer_id, c.name, o.order_id, o.order_date
        FROM cust c LEFT JOIN ord o ON c.customer_id = o.customer_id"""),
)
def join_left(spark, sf):
    return tables.customers(spark, sf).join(tables.orders(spark, sf), "customer_id", "left").select(
        "customer_id", "name", "order_id", "order_date"
    )


@query(
    "join_right",
    star("""SELECT o.order_id, o.status, i.line_number, i.quantity
        FROM item i RIGHT JOIN ord o ON o.order_id = i.order_id"""),
)
def join_right(spark, sf):
    return tables.items(spark, sf).join(tables.orders(spark, sf), "order_id", "right").select(
        "order_id", "status", "line_number", "quantity"
    )


@query(
    "join_full",
    star("""SELECT coalesce(l.k, r.k) AS key, CASE WHEN r.k IS NULL THEN 'left_only'
        WHEN l.k IS NULL THEN 'right_only' ELSE 'matched' END AS match
        FROM (SELECT DISTINCT customer_id AS k FROM ord) l
        FULL JOIN (SELECT DISTINCT user_id AS k FROM events) r ON l.k = r.k"""),
)
def join_full(spark, sf):
    buyers = tables.orders(spark, sf).select(F.col("customer_id").alias("key"))
    visitors = tables.load(spark, sf, "events").select(F.col("user_id").alias("key"))
    return R.reconcile(buyers, visitors, "key")


@query(
    "join_three_way",
    star("""SELECT o.order_id, o.order_date, p.name, i.line_number, i.quantity, CAST(i.gross AS DOUBLE) AS gross,
        CAST(i.discount AS DOUBLE) AS discount FROM ord o JOIN item i ON i.order_id = o.order_id
        JOIN prod p ON p.product_id = i.product_id"""),
)
def join_three_way(spark, sf):
    return commerce.lines_with_product(tables.star(spark, sf))


@query(
    "join_star",
    star(f"""SELECT c.city, p.category, count(*) AS lines, {money('sum(s.revenue)')} AS revenue
        FROM sold s JOIN cust c ON c.customer_id = s.customer_id
        JOIN prod p ON p.product_id = s.product_id GROUP BY 1, 2"""),
)
def join_star(spark, sf):
    return commerce.revenue_by_city_and_category(tables.star(spark, sf), ("P",))


def _bucketed(spark, sf, plan):
    """`plan` on orders and lines stored in buckets of the order."""
    return in_namespace(spark, "buckets", lambda name, path: plan(layout.bucketed_star(tables.star(spark, sf), name, path)))


@query("join_star_bucketed", ORACLES["join_star"])
def join_star_bucketed(spark, sf):
    return _bucketed(spark, sf, lambda s: commerce.revenue_by_city_and_category(s, ("P",)))


@query("join_three_way_bucketed", ORACLES["join_three_way"])
def join_three_way_bucketed(spark, sf):
    return _bucketed(spark, sf, commerce.lines_with_product)


@query(
    "join_broadcast",
    """SELECT n_name AS nation, r_name AS region, count(*) AS customers FROM customer
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""",
)
def join_broadcast(spark, sf):
    """Both dimensions are files whose size Spark knows; it broadcasts them by that."""
    nation, region = (tables.load(spark, sf, t) for t in ("nation", "region"))
    per_nation = tables.load(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers")
    )
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
        .agg(F.sum("customers").alias("customers"))
    )


@query(
    "join_semi",
    star("""SELECT * EXCLUDE (balance) FROM cust WHERE customer_id IN
        (SELECT customer_id FROM ord WHERE status = 'O')"""),
)
def join_semi(spark, sf):
    active = tables.orders(spark, sf).where("status = 'O'").select("customer_id")
    return tables.customers(spark, sf).drop("balance").join(active, "customer_id", "left_semi")


@query(
    "join_anti",
    star("SELECT order_id, customer_id FROM ord o WHERE NOT EXISTS (SELECT 1 FROM item i WHERE i.order_id = o.order_id)"),
)
def join_anti(spark, sf):
    s = tables.star(spark, sf)
    return s.orders.join(s.items.select("order_id"), "order_id", "left_anti").select(
        "order_id", "customer_id"
    )


@query(
    "join_cross_scalar",
    star(f"""SELECT category, count(*) AS products, {pct('count(*)', '(SELECT count(*) FROM prod)')} AS share_pct
        FROM prod GROUP BY category"""),
)
def join_cross_scalar(spark, sf):
    counts = tables.products(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("products"))
    return R.share_of_total(counts, "products", "share_pct")


_COHORT = """, f AS (SELECT customer_id, date_trunc('month', min(order_date)) AS c FROM kept GROUP BY 1)"""


def _first_months(orders):
    return counted(orders, ("P",)).groupBy("customer_id").agg(
        X.month_start(F.min("order_date")).alias("cohort")
    )


@query(
    "join_cte_cte",
    star(f"""{_COHORT}, n AS (SELECT c, count(*) AS size FROM f GROUP BY c),
        a AS (SELECT f.c, count(*) AS orders FROM kept k JOIN f ON f.customer_id = k.customer_id GROUP BY 1)
        SELECT strftime(n.c, '%Y-%m') AS cohort_month, n.size AS cohort_size, a.orders,
        {mean('a.orders', 'n.size')} AS orders_per_customer FROM a JOIN n ON n.c = a.c"""),
)
def join_cte_cte(spark, sf):
    orders = tables.orders(spark, sf)
    first = _first_months(orders)
    per_customer = counted(orders, ("P",)).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    activity = per_customer.join(first, "customer_id").groupBy("cohort").agg(F.sum("n").alias("orders"))
    return activity.join(sizes, "cohort").select(
        X.year_month("cohort").alias("cohort_month"),
        "cohort_size",
        "orders",
        X.mean_of("orders", "cohort_size").alias("orders_per_customer"),
    )


@query(
    "join_left_default",
    star("""SELECT c.customer_id, coalesce(o.n, 0) AS orders, CAST(coalesce(o.spend, 0) AS DOUBLE) AS spend
        FROM cust c LEFT JOIN (SELECT customer_id, count(*) AS n, sum(amount) AS spend FROM kept
        GROUP BY customer_id) o ON o.customer_id = c.customer_id"""),
)
def join_left_default(spark, sf):
    spend = counted(tables.orders(spark, sf), ("P",)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("spend")
    )
    return tables.customers(spark, sf).select("customer_id").join(spend, "customer_id", "left").select(
        "customer_id",
        F.coalesce("orders", F.lit(0).cast("long")).alias("orders"),
        F.coalesce("spend", F.lit(0)).cast("double").alias("spend"),
    )


@query(
    "join_band_residual",
    star(f"""{_COHORT} SELECT strftime(f.c, '%Y-%m') AS cohort_month, count(DISTINCT k.customer_id) AS customers,
        count(*) AS orders FROM kept k JOIN f ON f.customer_id = k.customer_id
        AND abs((k.order_date - CAST(f.c AS DATE)) - 30) <= 15
        AND date_trunc('month', k.order_date) <> f.c GROUP BY 1"""),
)
def join_band_residual(spark, sf):
    """Orders are counted per customer and day; days meet the cohorts of their bin only."""
    orders = tables.orders(spark, sf)
    days = counted(orders, ("P",)).groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    first = _first_months(orders).withColumn("cohort_day", F.unix_date("cohort"))
    placed = days.withColumn("day", F.unix_date("order_date"))
    near = R.band_join(placed, first, ["customer_id"], "day", "cohort_day", 15, 45)
    hits = near.where(X.month_start("order_date") != F.col("cohort"))
    return (
        hits.groupBy("cohort", "customer_id")
        .agg(F.sum("n").alias("n"))
        .groupBy("cohort")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("orders"))
        .select(X.year_month("cohort").alias("cohort_month"), "customers", "orders")
    )


# --- sub-queries -----------------------------------------------------------------------------


def _sales(spark, sf):
    return superstore.sales_rows(tables.star(spark, sf))


@query(
    "sub_scalar_filter",
    star(f"""SELECT order_id, customer_id, {money('sales')} AS sales FROM flat WHERE CAST(sales AS DOUBLE) >
        (SELECT CAST(sum(sales) AS DOUBLE) / count(*) FROM flat)"""),
)
def sub_scalar_filter(spark, sf):
    return superstore.above_average_sales(_sales(spark, sf))


@query(
    "sub_correlated_max",
    star(f"""SELECT f.customer_id, f.order_id, {money('f.sales')} AS top_sale FROM flat f
        WHERE f.sales = (SELECT max(g.sales) FROM flat g WHERE g.customer_id = f.customer_id)"""),
)
def sub_correlated_max(spark, sf):
    return superstore.biggest_sale_per_customer(_sales(spark, sf))


@query(
    "sub_cte_vs_avg",
    star("""SELECT customer_id, CAST(round(sales, 2) AS DOUBLE) AS total_sales FROM flat_by_customer
        WHERE CAST(round(sales, 2) AS DOUBLE) >
        (SELECT CAST(sum(round(sales, 2)) AS DOUBLE) / count(*) FROM flat_by_customer)"""),
)
def sub_cte_vs_avg(spark, sf):
    return superstore.big_spenders(_sales(spark, sf))


@query(
    "sub_scalar_select",
    star(f"""SELECT (SELECT count(*) FROM ord) AS orders, (SELECT count(DISTINCT customer_id) FROM ord) AS buyers,
        (SELECT {money('sum(amount)')} FROM ord) AS revenue, (SELECT count(*) FROM prod) AS products,
        (SELECT count(*) FROM cust WHERE balance < 0) AS indebted"""),
)
def sub_scalar_select(spark, sf):
    """Figures of one table fold into one aggregate; other tables are scalar subqueries."""
    s = tables.star(spark, sf)
    products = s.products.agg(F.count(F.lit(1))).scalar()
    indebted = s.customers.agg(F.count_if(F.col("balance") < 0)).scalar()
    per_buyer = s.orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("a")
    )
    return per_buyer.agg(
        F.sum("n").alias("orders"),
        F.count(F.lit(1)).alias("buyers"),
        X.rounded(F.sum("a")).alias("revenue"),
    ).select(
        "orders", "buyers", "revenue", products.alias("products"), indebted.alias("indebted")
    )


@query(
    "cte_join_window",
    star(f"""SELECT rank() OVER (ORDER BY round(f.sales, 2) DESC) AS sales_rank, f.customer_id, c.city AS segment,
        f.n AS orders, {money('f.sales')} AS total_sales, {money('f.profit')} AS total_profit
        FROM flat_by_customer f JOIN cust c ON c.customer_id = f.customer_id"""),
)
def cte_join_window(spark, sf):
    segments = tables.customers(spark, sf).withColumnRenamed("city", "segment")
    return superstore.ranked_with_segment(_sales(spark, sf), segments)


# --- aggregates ---------------------------------------------------------------------------------


@query("agg_count", star("SELECT count(*) AS total_orders FROM ord"))
def agg_count(spark, sf):
    return tables.orders(spark, sf).agg(F.count(F.lit(1)).alias("total_orders"))


@query(
    "agg_sum_filter",
    star("SELECT CAST(sum(amount) AS DOUBLE) AS delivered_revenue FROM ord WHERE status = 'F'"),
)
def agg_sum_filter(spark, sf):
    return tables.orders(spark, sf).where("status = 'F'").agg(
        F.sum("amount").cast("double").alias("delivered_revenue")
    )


@query(
    "agg_avg_group",
    star(f"SELECT category, {mean('sum(price)', 'count(price)')} AS avg_unit_price FROM prod GROUP BY category"),
)
def agg_avg_group(spark, sf):
    return tables.products(spark, sf).groupBy("category").agg(
        X.mean_of(F.sum("price"), F.count("price")).alias("avg_unit_price")
    )


@query(
    "agg_group_sort",
    star("""SELECT status, count(*) AS order_count, CAST(sum(amount) AS DOUBLE) AS total_revenue
        FROM ord GROUP BY status"""),
)
def agg_group_sort(spark, sf):
    return tables.orders(spark, sf).groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("amount").cast("double").alias("total_revenue")
    ).orderBy(F.desc("total_revenue"))


@query(
    "agg_min_max",
    star("""SELECT category, CAST(max(price) AS DOUBLE) AS max_price, CAST(min(price) AS DOUBLE) AS min_price
        FROM prod GROUP BY category"""),
)
def agg_min_max(spark, sf):
    return tables.products(spark, sf).groupBy("category").agg(
        F.max("price").cast("double").alias("max_price"),
        F.min("price").cast("double").alias("min_price"),
    )


@query(
    "agg_having",
    star(f"""SELECT brand, {mean('sum(price)', 'count(price)')} AS avg_price, count(DISTINCT category) AS categories
        FROM prod GROUP BY brand HAVING sum(price) > 950 * count(price) AND count(DISTINCT category) = 6"""),
)
def agg_having(spark, sf):
    return (
        tables.products(spark, sf)
        .groupBy("brand")
        .agg(
            F.sum("price").alias("total"),
            F.count("price").alias("n"),
            F.countDistinct("category").alias("categories"),
        )
        .where((F.col("total") > 950 * F.col("n")) & (F.col("categories") == 6))
        .select("brand", X.mean_of("total", "n").alias("avg_price"), "categories")
    )


@query(
    "agg_conditional",
    star(f"""SELECT {big("sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END)")} AS delivered_count,
        {big("sum(CASE WHEN status <> 'F' THEN 1 ELSE 0 END)")} AS not_delivered_count FROM ord"""),
)
def agg_conditional(spark, sf):
    return tables.orders(spark, sf).agg(
        F.count_if(F.col("status") == "F").alias("delivered_count"),
        F.count_if(F.col("status") != "F").alias("not_delivered_count"),
    )


@query(
    "agg_multi",
    star(f"""SELECT CAST(min(revenue) AS DOUBLE) AS minimum_sales, CAST(max(revenue) AS DOUBLE) AS maximum_sales,
        {mean('sum(revenue)', 'count(revenue)', 4)} AS average_sales FROM item"""),
)
def agg_multi(spark, sf):
    return tables.items(spark, sf).agg(
        F.min("revenue").cast("double").alias("minimum_sales"),
        F.max("revenue").cast("double").alias("maximum_sales"),
        X.mean_of(F.sum("revenue"), F.count("revenue"), 4).alias("average_sales"),
    )


@query(
    "agg_count_distinct",
    star("""SELECT return_flag, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products
        FROM item GROUP BY return_flag"""),
)
def agg_count_distinct(spark, sf):
    """Distinct pairs per column, counted and joined on the flag; two distinct counts in one aggregate
    would send every row twice.
    """
    lines = tables.items(spark, sf)

    def pairs(column, out):
        return lines.select("return_flag", column).distinct().groupBy("return_flag").agg(F.count(column).alias(out))

    orders, products = pairs("order_id", "orders"), pairs("product_id", "products").withColumnRenamed("return_flag", "_f")
    return orders.join(products, F.col("return_flag").eqNullSafe(F.col("_f"))).drop("_f")


@query(
    "agg_approx_distinct",
    star("""SELECT CAST(year(order_date) AS INTEGER) AS year, count(DISTINCT customer_id) AS customers, true AS estimate_is_close
        FROM kept GROUP BY 1"""),
)
def agg_approx_distinct(spark, sf):
    """The exact count per year beside the estimate from stored sketches of its months: 5 % off at most."""
    s = tables.star(spark, sf)
    sketches = staged(commerce.customer_sketches(s, ("P",)), "sketches")
    estimate = commerce.approximate_customers(sketches, F.year("month").alias("year")).withColumnRenamed("customers", "estimate")
    pairs = counted(s.orders, ("P",)).select(F.year("order_date").alias("year"), "customer_id").distinct()
    exact = pairs.groupBy("year").agg(F.count("customer_id").alias("customers"))
    close = F.abs(F.col("estimate") - F.col("customers")) <= F.col("customers") * 0.05 + 1
    return exact.join(estimate, "year").select("year", "customers", close.alias("estimate_is_close"))


@query(
    "agg_group_expr",
    star("""SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS num_orders,
        CAST(sum(amount) AS DOUBLE) AS revenue FROM ord GROUP BY 1"""),
)
def agg_group_expr(spark, sf):
    """Grouped by the month's first day; the text is made once per group."""
    return (
        tables.orders(spark, sf)
        .groupBy(X.month_start("order_date").alias("m"))
        .agg(F.count(F.lit(1)).alias("num_orders"), F.sum("amount").cast("double").alias("revenue"))
        .select(X.year_month("m").alias("month"), "num_orders", "revenue")
    )


@query(
    "agg_group_case",
    star("""SELECT CASE WHEN price < 930 THEN 'Budget' WHEN price <= 970 THEN 'Mid-Range'
        ELSE 'Premium' END AS price_tier, count(*) AS products FROM prod GROUP BY 1"""),
)
def agg_group_case(spark, sf):
    return tables.products(spark, sf).groupBy(
        X.price_tier("price", 930, 970).alias("price_tier")
    ).agg(F.count(F.lit(1)).alias("products"))


@query(
    "agg_ratio",
    star(f"""SELECT return_flag, {mean('sum(revenue)', 'count(DISTINCT order_id)')} AS value_per_order
        FROM item GROUP BY return_flag"""),
)
def agg_ratio(spark, sf):
    return tables.items(spark, sf).groupBy("return_flag").agg(
        X.mean_of(F.sum("revenue"), F.countDistinct("order_id")).alias("value_per_order")
    )


@query(
    "agg_two_level",
    star(f""", v AS (SELECT order_id, return_flag, sum(revenue) AS x FROM item GROUP BY 1, 2)
        SELECT return_flag, count(*) AS orders, {mean('sum(x)', 'count(*)')} AS avg_order_value
        FROM v GROUP BY return_flag"""),
)
def agg_two_level(spark, sf):
    values = tables.items(spark, sf).groupBy("order_id", "return_flag").agg(F.sum("revenue").alias("x"))
    return values.groupBy("return_flag").agg(
        F.count(F.lit(1)).alias("orders"),
        X.mean_of(F.sum("x"), F.count(F.lit(1))).alias("avg_order_value"),
    )


@query(
    "agg_pct_of_total",
    star(f"""SELECT payment_method, count(*) AS orders, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total
        FROM ord GROUP BY payment_method"""),
)
def agg_pct_of_total(spark, sf):
    counts = tables.orders(spark, sf).groupBy("payment_method").agg(F.count(F.lit(1)).alias("orders"))
    return R.share_of_total(counts, "orders", "pct_of_total")


@query(
    "agg_median",
    star("""SELECT category, round(median(CAST(price AS DOUBLE)), 4) AS median_price FROM prod GROUP BY category"""),
)
def agg_median(spark, sf):
    m = exact_median(tables.products(spark, sf), "price", ["category"], "median_price")
    return m.withColumn("median_price", F.round("median_price", 4))


@query(
    "agg_crosstab",
    star("SELECT city, country, count(*) AS customers FROM cust GROUP BY city, country"),
)
def agg_crosstab(spark, sf):
    return tables.customers(spark, sf).groupBy("city", "country").agg(
        F.count(F.lit(1)).alias("customers")
    )


_NATIONS = ", ".join(f'count(*) FILTER (country = {i}) AS "{i}"' for i in range(25))


@query("agg_crosstab_wide", star(f"SELECT city, {_NATIONS} FROM cust GROUP BY city"))
def agg_crosstab_wide(spark, sf):
    """One column per nation; a nation without customers anywhere still has one, as the nations are known."""
    people = tables.customers(spark, sf)
    wide = R.pivot_counts(people, "city", "country")
    nations = [str(r[0]) for r in tables.load(spark, sf, "nation").select("n_nationkey").collect()]
    return wide.select("city", *[(F.col(f"`{n}`") if n in wide.columns else F.lit(0)).cast("long").alias(n) for n in nations])


@query(
    "agg_value_counts",
    star("SELECT payment_method, count(*) AS count FROM ord GROUP BY payment_method"),
)
def agg_value_counts(spark, sf):
    return tables.orders(spark, sf).groupBy("payment_method").count().orderBy(F.desc("count"))


@query(
    "agg_histogram",
    star(""", e AS (SELECT min(CAST(amount AS DOUBLE)) AS low,
            (max(CAST(amount AS DOUBLE)) - min(CAST(amount AS DOUBLE))) / 10 AS width FROM ord),
        b AS (SELECT least(CAST(floor((CAST(amount AS DOUBLE) - low) / width) AS BIGINT), 9) AS bin, low, width FROM ord, e)
        SELECT bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, count(*) AS rows_in_bin
        FROM b GROUP BY bin, low, width"""),
)
def agg_histogram(spark, sf):
    return R.histogram(tables.orders(spark, sf), "amount", 10)


# --- sorting and top-k ---------------------------------------------------------------------------


@query(
    "sort_multi",
    star("""SELECT city, customer_id, CAST(balance AS DOUBLE) AS balance,
        row_number() OVER (ORDER BY city, balance DESC, customer_id) AS pos FROM cust"""),
)
def sort_multi(spark, sf):
    """Sorted, with the position as a column, so that the order itself can be compared."""
    order = [("city", False), ("balance", True), ("customer_id", False)]
    rows = tables.customers(spark, sf).select("city", "customer_id", "balance")
    return row_numbers(rows, order, out="pos").withColumn("balance", F.col("balance").cast("double")).orderBy("pos")


@query(
    "topk",
    star(f"""SELECT customer_id, {money('sales')} AS total_sales FROM flat_by_customer
        ORDER BY total_sales DESC, customer_id LIMIT 5"""),
)
def topk(spark, sf):
    return superstore.leaders(_sales(spark, sf), 5)


@query(
    "bottomk",
    star(f"""SELECT customer_id, {money('sales')} AS total_sales FROM flat_by_customer
        ORDER BY total_sales, customer_id LIMIT 5"""),
)
def bottomk(spark, sf):
    return superstore.leaders(_sales(spark, sf), 5, bottom=True)


@query(
    "topk_param",
    star("""SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM ord
        ORDER BY amount DESC, order_id LIMIT 1000"""),
)
def topk_param(spark, sf):
    rows = tables.orders(spark, sf).select("order_id", F.col("amount").cast("double").alias("amount"))
    return R.top_k(rows, 1000, F.desc("amount"), F.asc("order_id"))


@query(
    "head_sample",
    star("""(SELECT 'head' AS part, order_id, status FROM ord ORDER BY order_id LIMIT 5) UNION ALL
        (SELECT 'tail', order_id, status FROM ord ORDER BY order_id DESC LIMIT 5)"""),
)
def head_sample(spark, sf):
    rows = tables.orders(spark, sf).select("order_id", "status")
    head = R.top_k(rows, 5, F.asc("order_id")).select(F.lit("head").alias("part"), "*")
    tail = R.top_k(rows, 5, F.desc("order_id")).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


# --- scalar functions ------------------------------------------------------------------------------


@query(
    "fn_concat",
    star("SELECT customer_id, name || ' / ' || city AS label, concat('C-', customer_id) AS code FROM cust"),
)
def fn_concat(spark, sf):
    return tables.customers(spark, sf).select(
        "customer_id",
        F.concat_ws(" / ", "name", "city").alias("label"),
        F.concat(F.lit("C-"), F.col("customer_id").cast("string")).alias("code"),
    )


@query(
    "fn_substr",
    star("SELECT substr(CAST(order_date AS VARCHAR), 1, 7) AS month, count(*) AS n FROM ord GROUP BY 1"),
)
def fn_substr(spark, sf):
    text = F.col("order_date").cast("string")
    return tables.orders(spark, sf).groupBy(F.substring(text, 1, 7).alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "fn_lower_trim",
    star("SELECT customer_id, lower(trim('  ' || city || ' ')) AS city FROM cust"),
)
def fn_lower_trim(spark, sf):
    padded = F.concat(F.lit("  "), F.col("city"), F.lit(" "))
    return tables.customers(spark, sf).select("customer_id", F.lower(F.trim(padded)).alias("city"))


@query(
    "fn_replace",
    star("SELECT product_id, replace(replace(brand, '#', ''), 'Brand', 'B-') AS brand FROM prod"),
)
def fn_replace(spark, sf):
    plain = F.replace(F.col("brand"), F.lit("#"), F.lit(""))
    return tables.products(spark, sf).select(
        "product_id", F.replace(plain, F.lit("Brand"), F.lit("B-")).alias("brand")
    )


@query(
    "fn_year_month",
    star("""SELECT order_id, strftime(order_date, '%Y') AS year, strftime(order_date, '%m') AS month,
        strftime(order_date, '%Y-%m') AS year_month FROM ord"""),
)
def fn_year_month(spark, sf):
    return tables.orders(spark, sf).select(
        "order_id",
        F.date_format("order_date", "yyyy").alias("year"),
        F.date_format("order_date", "MM").alias("month"),
        X.year_month("order_date").alias("year_month"),
    )


@query(
    "fn_datediff",
    star(f"""SELECT i.order_id, i.line_number, {big('i.ship_date - o.order_date')} AS days
        FROM item i JOIN ord o ON o.order_id = i.order_id"""),
)
def fn_datediff(spark, sf):
    s = tables.star(spark, sf)
    return s.items.join(s.orders, "order_id").select(
        "order_id", "line_number", X.days_between("ship_date", "order_date").cast("long").alias("days")
    )


@query(
    "fn_days_since",
    star(f"SELECT customer_id, {big(f'''DATE '{AS_OF}' - max(order_date)''')} AS days_since FROM ord GROUP BY 1"),
)
def fn_days_since(spark, sf):
    last = tables.orders(spark, sf).groupBy("customer_id").agg(F.max("order_date").alias("last"))
    return last.select(
        "customer_id",
        X.days_between(F.lit(AS_OF).cast("date"), F.col("last")).cast("long").alias("days_since"),
    )


@query(
    "fn_month_offset",
    star(f"""SELECT i.order_id, i.line_number, {big('floor((i.ship_date - o.order_date) / 30.0)')} AS month_offset
        FROM item i JOIN ord o ON o.order_id = i.order_id"""),
)
def fn_month_offset(spark, sf):
    s = tables.star(spark, sf)
    return s.items.join(s.orders, "order_id").select(
        "order_id",
        "line_number",
        X.month_offset(X.days_between("ship_date", "order_date")).alias("month_offset"),
    )


@query(
    "fn_round",
    star("""SELECT product_id, CAST(round(price, 0) AS DOUBLE) AS r0, CAST(round(price, 1) AS DOUBLE) AS r1,
        round(CAST(price AS DOUBLE) / 7.0::DOUBLE, 2) AS r2, round(CAST(price AS DOUBLE) / 7.0::DOUBLE, 4) AS r4
        FROM prod"""),
)
def fn_round(spark, sf):
    seventh = F.col("price").cast("double") / F.lit(7.0)
    return tables.products(spark, sf).select(
        "product_id",
        X.rounded("price", 0).alias("r0"),
        X.rounded("price", 1).alias("r1"),
        F.round(seventh, 2).alias("r2"),
        F.round(seventh, 4).alias("r4"),
    )


@query("fn_abs", star("SELECT customer_id, CAST(abs(balance) AS DOUBLE) AS balance FROM cust"))
def fn_abs(spark, sf):
    return tables.customers(spark, sf).select(
        "customer_id", F.abs("balance").cast("double").alias("balance")
    )


@query(
    "fn_coalesce",
    star(f"{_HOLED} SELECT customer_id, coalesce(name, city, 'Unknown') AS label FROM h"),
)
def fn_coalesce(spark, sf):
    return _holed_customers(spark, sf).select(
        "customer_id", F.coalesce("name", "city", F.lit("Unknown")).alias("label")
    )


@query(
    "fn_map_lookup",
    star("""SELECT order_id, CASE status WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label FROM ord"""),
)
def fn_map_lookup(spark, sf):
    return tables.orders(spark, sf).select(
        "order_id", X.label_of("status", {"F": "finished", "O": "open"}).alias("label")
    )


@query(
    "fn_set_size",
    star(f"""SELECT user_id, {big('count(DISTINCT event_type)')} AS kinds FROM events GROUP BY user_id"""),
)
def fn_set_size(spark, sf):
    """A set of event kinds is bounded by the number of kinds."""
    return tables.load(spark, sf, "events").groupBy("user_id").agg(
        F.size(F.collect_set("event_type")).cast("long").alias("kinds")
    )


@query(
    "fn_case_bucket",
    star("""SELECT customer_id, CASE WHEN balance <= 0 THEN 'debt' WHEN balance <= 2500 THEN 'low'
        WHEN balance <= 7500 THEN 'middle' ELSE 'high' END AS band FROM cust"""),
)
def fn_case_bucket(spark, sf):
    return tables.customers(spark, sf).select(
        "customer_id",
        X.bucketize("balance", (0, 2500, 7500), ("debt", "low", "middle", "high")).alias("band"),
    )
