"""Business questions on the shop, the flat sales table and the commerce star."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import AS_OF, EXCLUDED, big, half_up, mean, money, pct, query, star
from millrace.functions.exprs import MONEY
from millrace.plans import cohort, commerce, reports, segments, shop, superstore
from millrace.sources import tables

# Limits in the size of the test data: a customer spends about 1.3 million.
SCALE = segments.Scale(
    spend=(500_000, 1_500_000),
    recency=(90, 180, 365, 720),
    frequency=(2, 4, 6, 10),
    monetary=(500_000, 1_000_000, 1_500_000, 2_000_000),
)
OPTIONS = reports.Options(limit=10, as_of=AS_OF, excluded=EXCLUDED, scale=SCALE)


# --- shop ---------------------------------------------------------------------


@query(
    "shop_monthly_trend",
    star(f"""SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS num_orders,
        {money('sum(amount)')} AS revenue FROM ord WHERE status <> 'P' GROUP BY 1"""),
)
def shop_monthly_trend(spark, sf):
    return shop.monthly_trend(tables.orders(spark, sf), "P")


@query(
    "shop_top_customers",
    star(f"""SELECT o.customer_id, c.name || ' of ' || c.city AS customer_name,
        {money('sum(o.amount)')} AS total_spend, count(*) AS order_count
        FROM ord o JOIN cust c ON c.customer_id = o.customer_id WHERE o.status <> 'P'
        GROUP BY 1, 2 ORDER BY total_spend DESC, o.customer_id LIMIT 3"""),
)
def shop_top_customers(spark, sf):
    named = tables.customers(spark, sf).withColumn(
        "customer_name", F.concat_ws(" of ", "name", "city")
    )
    return shop.top_customers(tables.orders(spark, sf), named, "P")


@query(
    "shop_top_products",
    star(f"""SELECT p.product_id, p.name AS product_name, {big('sum(quantity)')} AS total_qty_sold
        FROM sold s JOIN prod p ON p.product_id = s.product_id GROUP BY 1, 2
        ORDER BY total_qty_sold DESC, p.product_id LIMIT 3"""),
)
def shop_top_products(spark, sf):
    s = tables.star(spark, sf)
    return shop.top_products(
        s.orders, s.items, s.products.withColumnRenamed("name", "product_name"), "P"
    )


@query(
    "cust_country_summary",
    star(f"""SELECT country, count(*) AS customers, {mean('sum(balance)', 'count(balance)')} AS avg_purchase,
        {money('sum(balance)')} AS total_purchase FROM cust GROUP BY country"""),
)
def cust_country_summary(spark, sf):
    return shop.country_summary(tables.customers(spark, sf), "country", "balance")


@query(
    "cust_top_country",
    star(f"""SELECT country, {money('sum(balance)')} AS total_purchase FROM cust GROUP BY country
        ORDER BY total_purchase DESC, country LIMIT 8"""),
)
def cust_top_country(spark, sf):
    return shop.top_countries(tables.customers(spark, sf), "country", "balance")


@query(
    "cust_status_summary",
    star(f"""SELECT status, count(*) AS count, {mean('sum(amount)', 'count(amount)')} AS avg_purchase
        FROM ord GROUP BY status"""),
)
def cust_status_summary(spark, sf):
    return shop.status_summary(tables.orders(spark, sf), "status", "amount")


@query(
    "prod_fx_chain",
    star("""SELECT product_id, name, CAST(price AS DOUBLE) AS price,
        CAST(price AS DOUBLE) / 84.0::DOUBLE AS price_in_usd FROM prod WHERE category = 'PROMO'"""),
)
def prod_fx_chain(spark, sf):
    return shop.foreign_price_chain(tables.products(spark, sf), "PROMO")


# --- flat sales table -------------------------------------------------------------


def _flat(spark, sf):
    return superstore.flat_sales(tables.star(spark, sf))


def _sales(spark, sf):
    return superstore.sales_rows(tables.star(spark, sf))


def _segments(spark, sf):
    return tables.customers(spark, sf).withColumnRenamed("city", "segment")


def _goods(spark, sf):
    return tables.products(spark, sf).withColumnsRenamed(
        {"name": "product_name", "brand": "sub_category"}
    )


@query(
    "ss_overview",
    star(f"""SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS customers,
        count(DISTINCT order_id) AS orders, {money('sum(sales)')} AS total_sales FROM flat"""),
)
def ss_overview(spark, sf):
    return superstore.overview(_flat(spark, sf))


@query(
    "ss_customer_sales",
    star(f"""SELECT f.customer_id, c.city AS segment, {money('f.sales')} AS total_sales,
        f.n AS num_orders FROM flat_by_customer f JOIN cust c ON c.customer_id = f.customer_id"""),
)
def ss_customer_sales(spark, sf):
    return superstore.customer_sales(_sales(spark, sf), _segments(spark, sf))


@query(
    "ss_one_order",
    star("SELECT customer_id, n AS num_orders FROM flat_by_customer WHERE n = 1"),
)
def ss_one_order(spark, sf):
    return superstore.single_order_customers(_sales(spark, sf))


@query(
    "ss_category_sales",
    star(f"""SELECT category, {money('sum(sales)')} AS total_sales, {money('sum(profit)')} AS total_profit
        FROM flat GROUP BY category"""),
)
def ss_category_sales(spark, sf):
    return superstore.category_sales(_sales(spark, sf), _goods(spark, sf))


@query(
    "ss_top_subcategory",
    star(f"""SELECT sub_category, {money('sum(profit)')} AS total_profit FROM flat
        GROUP BY sub_category ORDER BY total_profit DESC, sub_category LIMIT 8"""),
)
def ss_top_subcategory(spark, sf):
    return superstore.top_sub_categories(_sales(spark, sf), _goods(spark, sf))


@query(
    "ss_region_avg",
    star(f"""SELECT category, {mean('sum(sales)', 'count(sales)')} AS average_sales FROM flat
        WHERE segment = 'BUILDING' GROUP BY category"""),
)
def ss_region_avg(spark, sf):
    return superstore.region_average(_flat(spark, sf), "segment", "BUILDING", "category", "sales")


@query(
    "ss_city_over_100",
    star("""SELECT product_id, count(*) AS record_count FROM item GROUP BY product_id
        HAVING count(*) > 30"""),
)
def ss_city_over_100(spark, sf):
    return superstore.frequent_groups(tables.items(spark, sf), "product_id", 30)


# --- commerce: totals ---------------------------------------------------------------


@query(
    "com_rev_customer",
    star(f"""SELECT c.customer_id, c.name AS customer_name, c.city, c.country, s.n AS total_orders,
        {big('s.units')} AS total_items_bought, {money('s.revenue')} AS lifetime_revenue
        FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id
        ORDER BY lifetime_revenue DESC, c.customer_id LIMIT 20"""),
)
def com_rev_customer(spark, sf):
    return commerce.revenue_by_customer(tables.star(spark, sf), EXCLUDED)


@query(
    "com_rev_category",
    star(f"""SELECT p.category, count(DISTINCT p.product_id) AS num_products,
        count(DISTINCT s.order_id) AS num_orders, {big('sum(s.quantity)')} AS units_sold,
        {money('sum(s.revenue)')} AS total_revenue, {mean('sum(s.gross)', 'count(s.gross)')} AS avg_unit_price
        FROM sold s JOIN prod p ON p.product_id = s.product_id GROUP BY p.category"""),
)
def com_rev_category(spark, sf):
    return commerce.revenue_by_category(tables.star(spark, sf), EXCLUDED)


@query(
    "com_rev_month",
    star(f"""SELECT strftime(order_date, '%Y') AS year, strftime(order_date, '%m') AS month,
        strftime(order_date, '%Y-%m') AS year_month, count(DISTINCT order_id) AS num_orders,
        {big('sum(quantity)')} AS units_sold, {money('sum(revenue)')} AS monthly_revenue
        FROM sold GROUP BY 1, 2, 3"""),
)
def com_rev_month(spark, sf):
    return commerce.revenue_by_month(tables.star(spark, sf), EXCLUDED)


@query(
    "com_top_qty",
    star(f"""SELECT p.product_id, p.name AS product_name, p.category,
        {big('sum(s.quantity)')} AS units_sold, count(DISTINCT s.order_id) AS order_count,
        {money('sum(s.revenue)')} AS total_revenue FROM sold s JOIN prod p ON p.product_id = s.product_id
        GROUP BY 1, 2, 3 ORDER BY units_sold DESC, p.product_id LIMIT 10"""),
)
def com_top_qty(spark, sf):
    return commerce.top_products_by_quantity(tables.star(spark, sf), EXCLUDED)


@query(
    "com_top_revenue",
    star(f"""SELECT p.product_id, p.name AS product_name, p.category,
        {big('sum(s.quantity)')} AS units_sold, {money('sum(s.revenue)')} AS total_revenue,
        {mean('sum(s.gross)', 'count(*)')} AS avg_price FROM sold s JOIN prod p ON p.product_id = s.product_id
        GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, p.product_id LIMIT 10"""),
)
def com_top_revenue(spark, sf):
    return commerce.top_products_by_revenue(tables.star(spark, sf), EXCLUDED)


_AOV = f"""count(DISTINCT order_id) AS total_orders, {money('sum(revenue)')} AS total_revenue,
    {mean('sum(revenue)', 'count(DISTINCT order_id)')} AS aov"""


@query("com_aov", star(f"SELECT {_AOV} FROM sold"))
def com_aov(spark, sf):
    return commerce.average_order_value(tables.star(spark, sf), EXCLUDED)


@query("com_aov_payment", star(f"SELECT payment_method, {_AOV} FROM sold GROUP BY payment_method"))
def com_aov_payment(spark, sf):
    return commerce.aov_by_payment(tables.star(spark, sf), EXCLUDED)


_FREQ = "CASE WHEN n = 1 THEN 'One-Time' WHEN n <= 4 THEN 'Occasional' ELSE 'Loyal' END"


@query(
    "com_aov_segment",
    star(f""", freq AS (SELECT customer_id, count(*) AS n FROM kept GROUP BY customer_id)
        SELECT {_FREQ} AS segment, count(*) AS total_orders, {money('sum(v.revenue)')} AS total_revenue,
        {mean('sum(v.revenue)', 'count(*)')} AS avg_order_value
        FROM value_of v JOIN freq f ON f.customer_id = v.customer_id GROUP BY 1"""),
)
def com_aov_segment(spark, sf):
    return commerce.aov_by_segment(tables.star(spark, sf), EXCLUDED)


@query(
    "com_rev_share",
    star(f""", r AS (SELECT category, sum(revenue) AS v FROM sold s JOIN prod p
        ON p.product_id = s.product_id GROUP BY category)
        SELECT category, {money('v')} AS revenue, {pct('v', '(SELECT sum(v) FROM r)')} AS revenue_share_pct
        FROM r"""),
)
def com_rev_share(spark, sf):
    return commerce.revenue_share(tables.star(spark, sf), EXCLUDED)


@query(
    "com_by_status",
    star(f"""SELECT o.status, count(DISTINCT o.order_id) AS num_orders, {money('sum(i.revenue)')} AS total_revenue,
        {mean('sum(i.revenue)', 'count(*)')} AS avg_item_value
        FROM ord o JOIN item i ON i.order_id = o.order_id GROUP BY o.status"""),
)
def com_by_status(spark, sf):
    return commerce.by_status(tables.star(spark, sf))


# --- commerce: rankings and trends -----------------------------------------------------


@query(
    "com_ltv_rank",
    star(""", v AS (SELECT c.customer_id, c.name AS customer_name, c.city, s.n AS total_orders,
        round(s.revenue, 2) AS x FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id)
        SELECT customer_id, customer_name, city, total_orders, CAST(x AS DOUBLE) AS lifetime_value,
        rank() OVER (ORDER BY x DESC) AS ltv_rank, dense_rank() OVER (ORDER BY x DESC) AS ltv_dense_rank,
        percent_rank() OVER (ORDER BY x) AS ltv_percentile FROM v ORDER BY x DESC, customer_id LIMIT 20"""),
)
def com_ltv_rank(spark, sf):
    return commerce.ltv_ranking(tables.star(spark, sf), EXCLUDED)


@query(
    "com_running_rev",
    star(""", d AS (SELECT order_date, round(sum(revenue), 2) AS x FROM sold GROUP BY order_date)
        SELECT order_date, CAST(x AS DOUBLE) AS daily_revenue, CAST(sum(x) OVER (ORDER BY order_date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM d"""),
)
def com_running_rev(spark, sf):
    return commerce.running_revenue(tables.star(spark, sf), EXCLUDED)


_MONTHS = """, m AS (SELECT strftime(order_date, '%Y-%m') AS ym, round(sum(revenue), 2) AS x
    FROM sold GROUP BY 1)"""


@query(
    "com_moving_avg",
    star(f"""{_MONTHS} SELECT ym AS year_month, CAST(x AS DOUBLE) AS revenue,
        {mean('sum(x) OVER w', 'count(x) OVER w')} AS moving_avg_3m FROM m
        WINDOW w AS (ORDER BY ym ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
)
def com_moving_avg(spark, sf):
    return commerce.moving_average(tables.star(spark, sf), EXCLUDED)


@query(
    "com_order_seq",
    star(f"""SELECT v.customer_id, c.name AS customer_name, v.order_id, v.order_date,
        {money('v.revenue')} AS order_value, row_number() OVER (PARTITION BY v.customer_id
        ORDER BY v.order_date, v.order_id) AS order_seq
        FROM value_of v JOIN cust c ON c.customer_id = v.customer_id
        ORDER BY v.customer_id, order_seq LIMIT 40"""),
)
def com_order_seq(spark, sf):
    return commerce.order_sequence(tables.star(spark, sf), EXCLUDED)


@query(
    "com_quartiles",
    star(""", v AS (SELECT c.customer_id, c.name, round(s.revenue, 2) AS x FROM spend_of s
        JOIN cust c ON c.customer_id = s.customer_id),
        t AS (SELECT *, ntile(4) OVER (ORDER BY x, customer_id) AS q FROM v)
        SELECT customer_id, name, CAST(x AS DOUBLE) AS total_spend, q AS spend_quartile,
        CASE q WHEN 1 THEN 'Q1 – Low' WHEN 2 THEN 'Q2 – Mid-Low' WHEN 3 THEN 'Q3 – Mid-High'
        ELSE 'Q4 – High' END AS quartile_label FROM t ORDER BY x DESC, customer_id DESC LIMIT 30"""),
)
def com_quartiles(spark, sf):
    return commerce.spend_quartiles(tables.star(spark, sf), EXCLUDED)


_GROWTH = "CASE WHEN {p} <> 0 THEN " + half_up("(revenue - {p}) * 100.0::DOUBLE / {p}", 2) + " END"


@query(
    "com_growth",
    star(f"""{_MONTHS}, l AS (SELECT ym AS month, CAST(x AS DOUBLE) AS revenue,
        CAST(lag(x, 1) OVER w AS DOUBLE) AS prev_month_revenue,
        CAST(lag(x, 3) OVER w AS DOUBLE) AS prev_quarter_revenue FROM m WINDOW w AS (ORDER BY ym))
        SELECT month, revenue, prev_month_revenue, {_GROWTH.format(p='prev_month_revenue')} AS mom_growth_pct,
        {_GROWTH.format(p='prev_quarter_revenue')} AS qoq_growth_pct FROM l"""),
)
def com_growth(spark, sf):
    return commerce.growth(tables.star(spark, sf), EXCLUDED)


@query(
    "com_cum_category",
    star(f""", r AS (SELECT p.category, strftime(s.order_date, '%Y-%m') AS ym, sum(s.revenue) AS v
        FROM sold s JOIN prod p ON p.product_id = s.product_id GROUP BY 1, 2)
        SELECT category, ym, {money('v')} AS monthly_revenue,
        {money('sum(v) OVER (PARTITION BY category ORDER BY ym)')} AS cumulative_revenue,
        {pct('v', 'sum(v) OVER (PARTITION BY ym)')} AS monthly_share_pct
        FROM r ORDER BY category, ym LIMIT 50"""),
)
def com_cum_category(spark, sf):
    return commerce.cumulative_by_category(tables.star(spark, sf), EXCLUDED)


@query(
    "com_lifespan",
    star(f"""SELECT c.customer_id, c.name, s.first_day AS first_order_date, s.last_day AS last_order_date,
        s.n AS total_orders, {money('s.revenue')} AS total_spend,
        {big('s.last_day - s.first_day')} AS customer_lifespan_days
        FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id
        ORDER BY customer_lifespan_days DESC, c.customer_id LIMIT 20"""),
)
def com_lifespan(spark, sf):
    return commerce.lifespans(tables.star(spark, sf), EXCLUDED)


# --- cohorts -----------------------------------------------------------------------------

_FIRST = """, f AS (SELECT customer_id, min(order_date) AS d, strftime(min(order_date), '%Y-%m') AS c
    FROM kept GROUP BY customer_id), n AS (SELECT c, count(*) AS size FROM f GROUP BY c)"""


@query("coh_size", star(f"{_FIRST} SELECT c AS cohort_month, size AS cohort_size FROM n"))
def coh_size(spark, sf):
    return cohort.cohort_sizes(tables.orders(spark, sf), EXCLUDED)


_GRID = f"""{_FIRST}, a AS (SELECT f.c, strftime(k.order_date, '%Y-%m') AS m,
    count(DISTINCT k.customer_id) AS active FROM kept k JOIN f ON f.customer_id = k.customer_id
    GROUP BY 1, 2)"""


@query(
    "coh_grid",
    star(f"""{_GRID} SELECT a.c AS cohort_month, a.m AS activity_month, n.size AS cohort_size,
        a.active AS active_customers, {pct('a.active', 'n.size')} AS retention_pct
        FROM a JOIN n ON n.c = a.c"""),
)
def coh_grid(spark, sf):
    return cohort.retention_grid(tables.orders(spark, sf), EXCLUDED)


@query(
    "coh_offset",
    star(f"""{_FIRST}, a AS (SELECT f.c, {big('floor((k.order_date - f.d) / 30.0)')} AS o, k.customer_id
        FROM kept k JOIN f ON f.customer_id = k.customer_id),
        b AS (SELECT c, o, count(DISTINCT customer_id) AS active FROM a WHERE o <= 12 GROUP BY c, o)
        SELECT b.c AS cohort_month, b.o AS month_offset, n.size AS cohort_size, b.active,
        {pct('b.active', 'n.size')} AS retention_pct FROM b JOIN n ON n.c = b.c"""),
)
def coh_offset(spark, sf):
    return cohort.retention_by_offset(tables.orders(spark, sf), EXCLUDED)


@query(
    "coh_churn",
    star(f""", f AS (SELECT customer_id, count(*) AS n FROM kept GROUP BY customer_id),
        g AS (SELECT CASE WHEN n = 1 THEN 'Churned (one-time)' ELSE 'Repeat Buyer' END AS customer_type,
        count(*) AS num_customers FROM f GROUP BY 1)
        SELECT *, {pct('num_customers', '(SELECT sum(num_customers) FROM g)')} AS pct_of_total FROM g"""),
)
def coh_churn(spark, sf):
    return cohort.churn(tables.orders(spark, sf), EXCLUDED)


@query(
    "coh_month1",
    star(f"""{_FIRST}, a AS (SELECT f.c, count(DISTINCT k.customer_id) AS active FROM kept k
        JOIN f ON f.customer_id = k.customer_id
        WHERE abs((k.order_date - CAST(f.c || '-01' AS DATE)) - 30) <= 15
        AND strftime(k.order_date, '%Y-%m') <> f.c GROUP BY f.c)
        SELECT n.c AS cohort_month, n.size AS cohort_size, coalesce(a.active, 0) AS month1_active,
        {pct('coalesce(a.active, 0)', 'n.size')} AS month1_retention_pct FROM n LEFT JOIN a ON a.c = n.c"""),
)
def coh_month1(spark, sf):
    return cohort.month_one(tables.orders(spark, sf), EXCLUDED)


# --- segments ------------------------------------------------------------------------------


@query(
    "seg_frequency",
    star(f""", f AS (SELECT customer_id, count(*) AS n FROM kept GROUP BY customer_id)
        SELECT {_FREQ} AS freq_segment, count(*) AS num_customers, {mean('sum(n)', 'count(*)')} AS avg_orders,
        min(n) AS min_orders, max(n) AS max_orders FROM f GROUP BY 1"""),
)
def seg_frequency(spark, sf):
    return segments.frequency_summary(tables.orders(spark, sf), EXCLUDED)


def _tier(value: str, labels) -> str:
    low, high = SCALE.spend
    return (
        f"CASE WHEN {value} < {low} THEN '{labels[0]}' WHEN {value} < {high} THEN '{labels[1]}' "
        f"ELSE '{labels[2]}' END"
    )


@query(
    "seg_spend",
    star(f"""SELECT {_tier('revenue', segments.SPEND_LONG_LABELS)} AS spend_tier, count(*) AS num_customers,
        {mean('sum(revenue)', 'count(*)')} AS avg_spend, {money('sum(revenue)')} AS total_revenue
        FROM spend_of GROUP BY 1"""),
)
def seg_spend(spark, sf):
    return segments.spend_summary(tables.star(spark, sf), EXCLUDED, SCALE)


@query(
    "seg_matrix",
    star(f"""SELECT {_FREQ} AS freq_seg, {_tier('revenue', segments.SPEND_LABELS)} AS spend_tier,
        count(*) AS num_customers FROM spend_of GROUP BY 1, 2"""),
)
def seg_matrix(spark, sf):
    return segments.segment_matrix(tables.star(spark, sf), EXCLUDED, SCALE)


def _reached(value: str, bounds) -> str:
    return "1 + " + " + ".join(f"CAST({value} >= {b} AS INTEGER)" for b in bounds)


_R, _F, _M = SCALE.recency, SCALE.frequency, SCALE.monetary
_RFM = f""", b AS (SELECT c.customer_id, c.name, {big(f"DATE '{AS_OF}' - s.last_day")} AS recency_days,
    s.n AS frequency, round(s.revenue, 2) AS x FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id),
    p AS (SELECT *, CAST(x AS DOUBLE) AS monetary,
    1 + {' + '.join(f'CAST(recency_days <= {v} AS INTEGER)' for v in _R)} AS r_score,
    {_reached('frequency', _F)} AS f_score, {_reached('x', _M)} AS m_score FROM b),
    q AS (SELECT *, r_score + f_score + m_score AS rfm_total FROM p)"""
_LABEL = """CASE WHEN rfm_total >= 13 THEN 'Champions' WHEN rfm_total >= 10 THEN 'Loyal Customers'
    WHEN rfm_total >= 7 THEN 'At Risk' WHEN rfm_total >= 4 THEN 'Dormant' ELSE 'Lost' END"""


@query(
    "rfm_scores",
    star(f"""{_RFM} SELECT customer_id, name, recency_days, frequency, monetary, r_score, f_score,
        m_score, rfm_total, {_LABEL} AS rfm_segment FROM q"""),
)
def rfm_scores(spark, sf):
    return segments.rfm_scores(tables.star(spark, sf), AS_OF, EXCLUDED, SCALE)


@query(
    "rfm_summary",
    star(f"""{_RFM} SELECT {_LABEL} AS rfm_segment, count(*) AS num_customers,
        {mean('sum(recency_days)', 'count(*)', 1)} AS avg_recency_days,
        {mean('sum(frequency)', 'count(*)', 1)} AS avg_frequency,
        {mean('sum(x)', 'count(*)')} AS avg_monetary, {money('sum(x)')} AS segment_revenue
        FROM q GROUP BY 1"""),
)
def rfm_summary(spark, sf):
    return segments.rfm_summary(tables.star(spark, sf), AS_OF, EXCLUDED, SCALE)


# --- reports ---------------------------------------------------------------------------------


def _report(name):
    return lambda spark, sf: reports.run_report(name, tables.star(spark, sf), OPTIONS)[name]


query(
    "rep_revenue",
    star(f"""SELECT p.category AS "Category", count(DISTINCT s.order_id) AS "Orders",
        {money('sum(s.revenue)')} AS "Revenue", {mean('sum(s.gross)', 'count(*)')} AS "Avg_Unit_Price"
        FROM sold s JOIN prod p ON p.product_id = s.product_id GROUP BY 1"""),
)(_report("revenue"))

query(
    "rep_top_customers",
    star(f"""SELECT c.customer_id AS "ID", c.name AS "Name", c.city AS "City", s.n AS "Total_Orders",
        {money('s.revenue')} AS "Lifetime_Value", dense_rank() OVER (ORDER BY s.revenue DESC) AS "LTV_Rank"
        FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id
        ORDER BY s.revenue DESC, c.customer_id LIMIT 10"""),
)(_report("top_customers"))

query(
    "rep_top_products",
    star(f""", t AS (SELECT product_id, sum(quantity) AS q, sum(revenue) AS v FROM sold GROUP BY 1)
        SELECT p.product_id AS "ID", p.name AS "Product", p.category AS "Category", {big('t.q')} AS "Qty_Sold",
        {money('t.v')} AS "Revenue", rank() OVER (ORDER BY t.q DESC) AS "Qty_Rank"
        FROM t JOIN prod p ON p.product_id = t.product_id ORDER BY t.v DESC, p.product_id LIMIT 10"""),
)(_report("top_products"))

query(
    "rep_monthly",
    star(f"""{_MONTHS}, l AS (SELECT ym, CAST(x AS DOUBLE) AS revenue,
        CAST(lag(x) OVER (ORDER BY ym) AS DOUBLE) AS p FROM m)
        SELECT ym AS "Month", revenue AS "Revenue", {_GROWTH.format(p='p')} AS "Growth_Pct" FROM l"""),
)(_report("monthly_revenue"))

query(
    "rep_aov",
    star(f""", s AS (SELECT *, CAST(revenue AS DOUBLE) / n AS own FROM spend_of)
        SELECT {_FREQ} AS "Segment", {_tier('revenue', segments.SPEND_REPORT_LABELS)} AS "Spend_Tier",
        count(*) AS "Customers", {half_up('avg(own)', 2)} AS "Avg_Order_Value" FROM s GROUP BY 1, 2"""),
)(_report("aov"))

query(
    "rep_retention",
    star(f"""{_GRID} SELECT a.c AS "Cohort", a.m AS "Month", n.size AS "Cohort_Size", a.active AS "Active",
        {pct('a.active', 'n.size')} AS "Retention_Pct" FROM a JOIN n ON n.c = a.c ORDER BY 1, 2 LIMIT 60"""),
)(_report("retention"))

query(
    "rep_segmentation",
    star(f""", v AS (SELECT c.customer_id, c.name, s.n, round(s.revenue, 2) AS x, s.last_day
        FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id)
        SELECT customer_id AS "ID", name AS "Name", n AS "Orders", CAST(x AS DOUBLE) AS "Total_Spend",
        last_day AS "Last_Order", {_FREQ} AS "Frequency_Segment",
        {_tier('x', segments.SPEND_LABELS)} AS "Spend_Tier" FROM v ORDER BY x DESC, customer_id LIMIT 30"""),
)(_report("segmentation"))

query(
    "rep_rfm",
    star(f"""{_RFM} SELECT customer_id AS "ID", name AS "Name", CAST(recency_days AS DOUBLE) AS "Recency_Days",
        frequency AS "Frequency", monetary AS "Monetary", r_score AS "R", f_score AS "F", m_score AS "M",
        rfm_total AS "RFM_Total", CASE WHEN rfm_total >= 13 THEN '🏆 Champions'
        WHEN rfm_total >= 10 THEN '💎 Loyal' WHEN rfm_total >= 7 THEN '🔄 At Risk' ELSE '😴 Churned' END
        AS "RFM_Segment" FROM q ORDER BY rfm_total DESC, customer_id LIMIT 25"""),
)(_report("rfm"))


@query(
    "rep_registry",
    star(f"""{_FIRST}, counts AS (SELECT
        (SELECT count(DISTINCT p.category) FROM sold s JOIN prod p ON p.product_id = s.product_id) AS categories,
        (SELECT count(*) FROM spend_of s JOIN cust c ON c.customer_id = s.customer_id) AS customers,
        (SELECT count(DISTINCT s.product_id) FROM sold s JOIN prod p ON p.product_id = s.product_id) AS products,
        (SELECT count(DISTINCT strftime(order_date, '%Y-%m')) FROM sold) AS months,
        (SELECT count(*) FROM (SELECT DISTINCT {_FREQ}, {_tier('revenue', segments.SPEND_LABELS)} FROM spend_of)) AS cells,
        (SELECT count(*) FROM (SELECT DISTINCT f.c, strftime(k.order_date, '%Y-%m') FROM kept k
            JOIN f ON f.customer_id = k.customer_id)) AS grid)
        SELECT 'revenue' AS report, 'Total Revenue by Category' AS title, categories AS result_rows FROM counts
        UNION ALL SELECT 'top_customers', 'Top Customers by Lifetime Value', least(customers, 10) FROM counts
        UNION ALL SELECT 'top_products', 'Top Products by Revenue', least(products, 10) FROM counts
        UNION ALL SELECT 'monthly_revenue', 'Monthly Revenue with Growth %', months FROM counts
        UNION ALL SELECT 'aov', 'Average Order Value by Segment', cells FROM counts
        UNION ALL SELECT 'retention', 'Cohort Retention Analysis', least(grid, 60) FROM counts
        UNION ALL SELECT 'segmentation', 'Customer Segmentation', least(customers, 30) FROM counts
        UNION ALL SELECT 'rfm', 'RFM Analysis', least(customers, 25) FROM counts"""),
)
def rep_registry(spark, sf):
    return reports.report_index(tables.star(spark, sf), OPTIONS)
