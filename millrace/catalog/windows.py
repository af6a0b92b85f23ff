"""Window functions over whole tables, in the distributed form."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.catalog.registry import money, pct, query, star
from millrace.functions import exprs as X
from millrace.operators import windows as W
from millrace.plans import commerce, superstore
from millrace.session import staged
from millrace.sources import tables

_TIES = ["order_id", "line_number", "product_id", "supplier_id", "quantity"]


@query(
    "win_row_number",
    star(f"""SELECT category, product_name, {money('sales')} AS sales, row_number() OVER
        (PARTITION BY category ORDER BY sales DESC, {', '.join(_TIES)}) AS row_num FROM flat"""),
)
def win_row_number(spark, sf):
    s = tables.star(spark, sf)
    goods = s.products.withColumnRenamed("name", "product_name")
    sales = s.items.withColumnRenamed("revenue", "sales")
    return superstore.numbered_in_category(sales, goods, _TIES)


@query(
    "win_order_seq",
    star(f"""SELECT customer_id, order_id, order_date, {money('revenue')} AS order_value,
        row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS order_seq
        FROM value_of"""),
)
def win_order_seq(spark, sf):
    values = commerce.order_values(tables.star(spark, sf), ("P",)).select(
        "customer_id", "order_id", "order_date", X.rounded("revenue").alias("order_value")
    )
    return W.row_numbers(
        staged(values), [("order_date", False), ("order_id", False)], ["customer_id"], "order_seq"
    )


@query(
    "win_rank",
    star(f"""SELECT customer_id, {money('sales')} AS total_sales, rank() OVER (ORDER BY sales DESC) AS rank
        FROM flat_by_customer"""),
)
def win_rank(spark, sf):
    return superstore.ranked_customers(superstore.sales_rows(tables.star(spark, sf)))


@query(
    "win_dense_rank",
    star("""SELECT product_id, quantity, dense_rank() OVER (ORDER BY quantity DESC) AS dense_rank FROM item"""),
)
def win_dense_rank(spark, sf):
    rows = tables.items(spark, sf).select("product_id", "quantity")
    return W.ranks(rows, [("quantity", True)], dense="dense_rank")


@query(
    "win_percent_rank",
    star("""SELECT customer_id, country, percent_rank() OVER (PARTITION BY country ORDER BY balance) AS pr FROM cust"""),
)
def win_percent_rank(spark, sf):
    rows = tables.customers(spark, sf).select("customer_id", "country", "balance")
    return W.ranks(rows, [("balance", False)], ["country"], percent="pr").drop("balance")


@query(
    "win_ntile",
    star("""SELECT customer_id, CAST(round(revenue, 2) AS DOUBLE) AS total_spend,
        ntile(4) OVER (ORDER BY round(revenue, 2), customer_id) AS spend_quartile FROM spend_of"""),
)
def win_ntile(spark, sf):
    spend = commerce.customer_totals(tables.star(spark, sf), ("P",)).select(
        "customer_id", F.round("revenue", 2).alias("value")
    )
    tiled = W.ntiles(staged(spend), 4, [("value", False), ("customer_id", False)], out="spend_quartile")
    return tiled.select(
        "customer_id", F.col("value").cast("double").alias("total_spend"), "spend_quartile"
    )


_MONTHS = """, m AS (SELECT strftime(order_date, '%Y-%m') AS ym, sum(amount) AS x FROM ord GROUP BY 1)"""


def _months(spark, sf):
    return (
        tables.orders(spark, sf)
        .groupBy(X.month_start("order_date").alias("m"))
        .agg(F.sum("amount").alias("x"))
    )


@query(
    "win_lag",
    star(f"""{_MONTHS} SELECT ym, CAST(x AS DOUBLE) AS revenue, CAST(lag(x, 1) OVER (ORDER BY ym) AS DOUBLE) AS prev_1,
        CAST(lag(x, 3) OVER (ORDER BY ym) AS DOUBLE) AS prev_3 FROM m"""),
)
def win_lag(spark, sf):
    w = W.calendar_window(order="m")
    x = F.col("x").cast("double")
    return _months(spark, sf).select(
        X.year_month("m").alias("ym"),
        x.alias("revenue"),
        F.lag(x, 1).over(w).alias("prev_1"),
        F.lag(x, 3).over(w).alias("prev_3"),
    )


@query(
    "win_running_rows",
    star("""SELECT order_id, order_date, CAST(sum(amount) OVER (ORDER BY order_date, order_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM ord"""),
)
def win_running_rows(spark, sf):
    rows = tables.orders(spark, sf).select("order_id", "order_date", "amount")
    run = W.prefix_sums(
        rows, [("order_date", False), ("order_id", False)], {"running_total": F.col("amount")}
    )
    return run.select("order_id", "order_date", F.col("running_total").cast("double").alias("running_total"))


@query(
    "win_running_range",
    star(f"""SELECT order_date, order_id, {money('sales')} AS sale,
        {money('sum(sales) OVER (ORDER BY order_date)')} AS running_total FROM flat"""),
)
def win_running_range(spark, sf):
    return superstore.running_sales(superstore.sales_rows(tables.star(spark, sf)))


@query(
    "win_running_part",
    star("""SELECT customer_id, order_id, CAST(sum(amount) OVER (PARTITION BY customer_id
        ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS spent_so_far FROM ord"""),
)
def win_running_part(spark, sf):
    rows = tables.orders(spark, sf).select("customer_id", "order_id", "order_date", "amount")
    run = W.prefix_sums(
        rows,
        [("order_date", False), ("order_id", False)],
        {"spent_so_far": F.col("amount")},
        ["customer_id"],
    )
    return run.select("customer_id", "order_id", F.col("spent_so_far").cast("double").alias("spent_so_far"))


@query(
    "win_moving_avg",
    star(f"""{_MONTHS} SELECT ym, round(CAST(sum(x) OVER w AS DOUBLE) / count(*) OVER w, 2) AS moving_avg_3m
        FROM m WINDOW w AS (ORDER BY ym ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
)
def win_moving_avg(spark, sf):
    w = W.calendar_window(order="m").rowsBetween(-2, 0)
    return _months(spark, sf).select(
        X.year_month("m").alias("ym"),
        X.mean_of(F.sum("x").over(w), F.count("x").over(w)).alias("moving_avg_3m"),
    )


@query(
    "win_share",
    star(f""", r AS (SELECT payment_method, strftime(order_date, '%Y-%m') AS ym, sum(amount) AS x FROM ord GROUP BY 1, 2)
        SELECT payment_method, ym, {pct('x', 'sum(x) OVER (PARTITION BY ym)')} AS share_pct FROM r"""),
)
def win_share(spark, sf):
    cells = (
        tables.orders(spark, sf)
        .groupBy("payment_method", X.month_start("order_date").alias("m"))
        .agg(F.sum("amount").alias("x"))
    )
    month = Window.partitionBy("m")
    return cells.select(
        "payment_method",
        X.year_month("m").alias("ym"),
        X.pct(F.col("x"), F.sum("x").over(month)).alias("share_pct"),
    )


@query(
    "win_prior_count",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1
        AS prior_events FROM events""",
)
def win_prior_count(spark, sf):
    rows = tables.load(spark, sf, "events").select("event_id", "user_id", "ts")
    return W.prior_counts(
        rows, [("ts", False), ("event_id", False)], ["user_id"], "prior_events"
    ).drop("ts")


@query(
    "win_distinct_set",
    """SELECT event_id, user_id, (SELECT count(DISTINCT e.event_type) FROM events e
        WHERE e.user_id = o.user_id) AS kinds FROM events o""",
)
def win_distinct_set(spark, sf):
    rows = tables.load(spark, sf, "events").select("event_id", "user_id", "event_type")
    return W.distinct_per_key(rows, ["user_id"], "event_type", "kinds").drop("event_type")


@query(
    "win_first_last",
    star("""SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
        count(*) AS total_orders FROM ord GROUP BY customer_id"""),
)
def win_first_last(spark, sf):
    return tables.orders(spark, sf).groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("total_orders"),
    )
