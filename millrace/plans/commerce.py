"""Revenue, order value, ranking, trend and lifespan over the star of four tables.

Money is summed as decimal and items are summed per order (or per product) before
they meet another table, so a customer or order holding a large part of the rows
has shrunk to one row per task by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import (
    days_between,
    growth_pct,
    label_of,
    mean_of,
    money_sum,
    month_start,
    pct,
    rounded,
    year_month,
)
from millrace.operators.relational import top_k
from millrace.operators.windows import calendar_window
from millrace.session import staged
from millrace.sources.tables import Star

# The order states that do not count as sales.
EXCLUDED = ("cancelled", "returned")
QUARTILE_LABELS = {1: "Q1 – Low", 2: "Q2 – Mid-Low", 3: "Q3 – Mid-High", 4: "Q4 – High"}


def counted(orders: DataFrame, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """Orders in a counted state; a NULL state is not counted, unless nothing is excluded."""
    if not excluded:
        return orders
    return orders.where(~F.col("status").isin(*excluded))


def sold_items(s: Star, excluded: Sequence[str] = EXCLUDED, *extra: str) -> DataFrame:
    """Items of counted orders, with the order columns named in `extra`."""
    return s.items.join(counted(s.orders, excluded).select("order_id", *extra), "order_id")


def order_values(s: Star, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """One row per counted order that has items: revenue, units, lines."""
    per_order = s.items.groupBy("order_id").agg(
        money_sum("revenue_units", 4).alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"),
    )
    return counted(s.orders, excluded).join(per_order, "order_id")


def customer_totals(s: Star, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """Per customer: orders, units, revenue, first and last order date.

    Orders are unique by id, so a plain count is the distinct count.
    """
    return (
        order_values(s, excluded)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


def customer_sales(s: Star, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """customer_totals with the customer's name, city and country."""
    return customer_totals(s, excluded).join(
        s.customers.select("customer_id", "name", "city", "country"), "customer_id"
    )


def product_totals(s: Star, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """Per product: units, revenue, lines and summed line price, with the product's name."""
    per_product = (
        sold_items(s, excluded)
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("units"),
            money_sum("revenue_units", 4).alias("revenue"),
            money_sum("gross_cents", 2).alias("gross"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    return per_product.join(s.products.select("product_id", "name", "category"), "product_id")


def monthly_revenue(s: Star, excluded: Sequence[str] = EXCLUDED) -> DataFrame:
    """One row per month: month_start, revenue, units, orders."""
    return (
        order_values(s, excluded)
        .groupBy(month_start("order_date").alias("month_start"))
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("units").alias("units"),
            F.count(F.lit(1)).alias("num_orders"),
        )
    )


# --- totals -------------------------------------------------------------------


def revenue_by_customer(s: Star, excluded=EXCLUDED, limit: int = 20) -> DataFrame:
    rows = customer_sales(s, excluded).select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "city",
        "country",
        "total_orders",
        F.col("units").alias("total_items_bought"),
        rounded("revenue").alias("lifetime_revenue"),
    )
    return top_k(rows, limit, F.desc("lifetime_revenue"), F.asc("customer_id"))


def revenue_by_category(s: Star, excluded=EXCLUDED) -> DataFrame:
    """Totals from one row per product; orders from distinct (category, order) pairs."""
    category = s.products.select("product_id", "category")
    totals = (
        product_totals(s, excluded)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("num_products"),
            F.sum("units").alias("units_sold"),
            rounded(F.sum("revenue")).alias("total_revenue"),
            mean_of(F.sum("gross"), F.sum("lines")).alias("avg_unit_price"),
        )
    )
    pairs = sold_items(s, excluded).join(category, "product_id").select("category", "order_id").distinct()
    orders = pairs.groupBy("category").agg(F.count(F.lit(1)).alias("num_orders"))
    rows = totals.join(orders.withColumnRenamed("category", "_c"), F.col("category").eqNullSafe(F.col("_c")))
    return rows.select(
        "category", "num_products", "num_orders", "units_sold", "total_revenue", "avg_unit_price"
    ).orderBy(F.desc("total_revenue"))


def revenue_by_city_and_category(s: Star, excluded=EXCLUDED) -> DataFrame:
    """Lines and revenue over the whole star."""
    facts = s.items.join(counted(s.orders, excluded).select("order_id", "customer_id"), "order_id")
    return (
        facts.join(s.customers.select("customer_id", "city"), "customer_id")
        .join(s.products.select("product_id", "category"), "product_id")
        .groupBy("city", "category")
        .agg(F.count(F.lit(1)).alias("lines"), rounded(money_sum("revenue_units", 4)).alias("revenue"))
    )


def lines_with_product(s: Star) -> DataFrame:
    """Every line with its order's day and its product's name."""
    return s.items.join(s.orders.select("order_id", "order_date"), "order_id").join(
        s.products.select("product_id", "name"), "product_id"
    ).select(
        "order_id", "order_date", "name", "line_number", "quantity",
        F.col("gross").cast("double").alias("gross"),
        F.col("discount").cast("double").alias("discount"),
    )


def customer_sketches(s: Star, excluded=EXCLUDED, precision: int = 12) -> DataFrame:
    """(month, customers): a sketch of the distinct customers of each month, a few kilobytes whatever their number.

    Sketches of any months unite, which distinct counts do not; `precision` 12 errs by about 1.6 %.
    """
    month = month_start("order_date").alias("month")
    return counted(s.orders, excluded).groupBy(month).agg(F.hll_sketch_agg("customer_id", F.lit(precision)).alias("customers"))


def approximate_customers(sketches: DataFrame, *period: Column) -> DataFrame:
    """Distinct customers of each period, from the sketches of its months."""
    return sketches.groupBy(*period).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))


def revenue_by_month(s: Star, excluded=EXCLUDED) -> DataFrame:
    return (
        monthly_revenue(s, excluded)
        .select(
            F.date_format("month_start", "yyyy").alias("year"),
            F.date_format("month_start", "MM").alias("month"),
            year_month("month_start").alias("year_month"),
            "num_orders",
            F.col("units").alias("units_sold"),
            rounded("revenue").alias("monthly_revenue"),
        )
        .orderBy("year_month")
    )


def top_products_by_quantity(s: Star, excluded=EXCLUDED, limit: int = 10) -> DataFrame:
    """The leaders by units, then their distinct orders counted for those rows only."""
    leaders = top_k(product_totals(s, excluded), limit, F.desc("units"), F.asc("product_id"))
    orders = (
        sold_items(s, excluded)
        .join(leaders.select("product_id"), "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.countDistinct("order_id").alias("order_count"))
    )
    return (
        leaders.join(orders, "product_id")
        .select(
            "product_id",
            F.col("name").alias("product_name"),
            "category",
            F.col("units").alias("units_sold"),
            "order_count",
            rounded("revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("units_sold"), "product_id")
    )


def top_products_by_revenue(s: Star, excluded=EXCLUDED, limit: int = 10) -> DataFrame:
    rows = product_totals(s, excluded).select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        F.col("units").alias("units_sold"),
        rounded("revenue").alias("total_revenue"),
        mean_of("gross", "lines").alias("avg_price"),
    )
    return top_k(rows, limit, F.desc("total_revenue"), F.asc("product_id"))


# --- order value ----------------------------------------------------------------


def _aov(orders: DataFrame, *keys: str) -> DataFrame:
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_orders"),
        rounded(F.sum("revenue")).alias("total_revenue"),
        mean_of(F.sum("revenue"), F.count(F.lit(1))).alias("aov"),
    )


def average_order_value(s: Star, excluded=EXCLUDED) -> DataFrame:
    return _aov(order_values(s, excluded))


def aov_by_payment(s: Star, excluded=EXCLUDED) -> DataFrame:
    return _aov(order_values(s, excluded), "payment_method").orderBy(F.desc("aov"))


def frequency_segment(count: Column | str) -> Column:
    """One-Time, Occasional (2 to 4 orders) or Loyal."""
    c = F.col(count) if isinstance(count, str) else count
    return F.when(c == 1, "One-Time").when(c.between(2, 4), "Occasional").otherwise("Loyal")


def order_frequency(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """Counted orders per customer, those without items included."""
    return counted(orders, excluded).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count")
    )


def aov_by_segment(s: Star, excluded=EXCLUDED) -> DataFrame:
    """Order values per customer are summed before they are joined to the segment."""
    spend = customer_totals(s, excluded).select("customer_id", "total_orders", "revenue")
    return (
        spend.join(order_frequency(s.orders, excluded), "customer_id")
        .groupBy(frequency_segment("order_count").alias("segment"))
        .agg(
            F.sum("total_orders").alias("total_orders"),
            rounded(F.sum("revenue")).alias("total_revenue"),
            mean_of(F.sum("revenue"), F.sum("total_orders")).alias("avg_order_value"),
        )
        .orderBy(F.desc("avg_order_value"))
    )


def _category_revenue(s: Star, excluded) -> DataFrame:
    return product_totals(s, excluded).groupBy("category").agg(F.sum("revenue").alias("revenue"))


def revenue_share(s: Star, excluded=EXCLUDED) -> DataFrame:
    """The grand total is a window over one row per category: the sales are read once."""
    whole = F.sum("revenue").over(Window.partitionBy(F.lit(0)))
    return (
        _category_revenue(s, excluded)
        .select(
            "category",
            rounded("revenue").alias("revenue"),
            pct(F.col("revenue"), whole).alias("revenue_share_pct"),
        )
        .orderBy(F.desc("revenue"))
    )


def by_status(s: Star) -> DataFrame:
    """All states; the average is per item, not per order."""
    return (
        order_values(s, excluded=())
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("num_orders"),
            rounded(F.sum("revenue")).alias("total_revenue"),
            mean_of(F.sum("revenue"), F.sum("lines")).alias("avg_item_value"),
        )
        .orderBy(F.desc("num_orders"))
    )


# --- rankings -------------------------------------------------------------------


def ltv_ranking(s: Star, excluded=EXCLUDED, limit: int = 20) -> DataFrame:
    """rank, dense_rank and percent_rank of the leading customers.

    Everything above a leader is a leader too, so ranks over the `limit` rows are the
    global ones.  The ascending percent rank needs the rows below: all rows minus those
    above minus the ties, and the ties are counted for the leaders' values only.
    """
    ltv = staged(
        customer_sales(s, excluded).select(
            "customer_id",
            F.col("name").alias("customer_name"),
            "city",
            "total_orders",
            F.round("revenue", 2).alias("value"),
        )
    )
    top = top_k(ltv, limit, F.desc("value"), F.asc("customer_id"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("value"))
    ranked = top.withColumn("ltv_rank", F.rank().over(down).cast("long")).withColumn(
        "ltv_dense_rank", F.dense_rank().over(down).cast("long")
    )
    ties = (
        ltv.select("value")
        .join(top.select("value").distinct(), "value", "left_semi")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("ties"))
    )
    n = ltv.agg(F.count(F.lit(1))).scalar()
    below = F.col("n") - (F.col("ltv_rank") - 1) - F.col("ties")
    return (
        ranked.join(ties, "value")
        .withColumn("n", n)
        .select(
            "customer_id",
            "customer_name",
            "city",
            "total_orders",
            F.col("value").cast("double").alias("lifetime_value"),
            "ltv_rank",
            "ltv_dense_rank",
            F.when(F.col("n") > 1, below.cast("double") / (F.col("n") - 1))
            .otherwise(F.lit(0.0))
            .alias("ltv_percentile"),
        )
        .orderBy("ltv_rank", "customer_id")
    )


def spend_quartiles(s: Star, excluded=EXCLUDED, limit: int = 30) -> DataFrame:
    """Quartile of the biggest spenders.

    The position from the top and the number of customers give the ascending row
    number, and that the tile, without sorting all customers.
    """
    spend = staged(
        customer_sales(s, excluded).select(
            "customer_id", "name", F.round("revenue", 2).alias("value")
        )
    )
    top = top_k(spend, limit, F.desc("value"), F.desc("customer_id"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("value"), F.desc("customer_id"))
    n = spend.agg(F.count(F.lit(1))).scalar()
    small, extra = F.floor(F.col("n") / 4), F.pmod(F.col("n"), F.lit(4))
    edge = extra * (small + 1)
    tile = F.when(F.col("r") <= edge, F.ceil(F.col("r") / (small + 1))).otherwise(
        extra + F.ceil(F.try_divide(F.col("r") - edge, small))
    )
    return (
        top.withColumn("n", n)
        .withColumn("r", F.col("n") - F.row_number().over(down) + 1)
        .withColumn("spend_quartile", tile.cast("long"))
        .select(
            "customer_id",
            "name",
            F.col("value").cast("double").alias("total_spend"),
            "spend_quartile",
            label_of(F.col("spend_quartile").cast("int"), QUARTILE_LABELS).alias("quartile_label"),
        )
        .orderBy(F.desc("total_spend"), F.desc("customer_id"))
    )


def order_sequence(s: Star, excluded=EXCLUDED, limit: int = 40) -> DataFrame:
    """Sequence of orders per customer, first rows by customer.

    The report order is the sequence order, so a customer's earlier orders are always
    among the rows kept and the numbering may follow the limit.
    """
    rows = order_values(s, excluded).join(s.customers.select("customer_id", "name"), "customer_id")
    first = top_k(rows, limit, F.asc("customer_id"), F.asc("order_date"), F.asc("order_id"))
    seq = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    return first.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "order_id",
        "order_date",
        rounded("revenue").alias("order_value"),
        F.row_number().over(seq).cast("long").alias("order_seq"),
    ).orderBy("customer_id", "order_seq")


# --- trends (one row per day or month) --------------------------------------------


def running_revenue(s: Star, excluded=EXCLUDED) -> DataFrame:
    daily = (
        order_values(s, excluded)
        .groupBy("order_date")
        .agg(F.round(F.sum("revenue"), 2).alias("v"))
    )
    upto = calendar_window(order="order_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "order_date",
        F.col("v").cast("double").alias("daily_revenue"),
        rounded(F.sum("v").over(upto)).alias("running_total"),
    ).orderBy("order_date")


def moving_average(s: Star, excluded=EXCLUDED, months: int = 3) -> DataFrame:
    frame = calendar_window(order="month_start").rowsBetween(1 - months, 0)
    v = F.round("revenue", 2)
    return (
        monthly_revenue(s, excluded)
        .select(
            year_month("month_start").alias("year_month"),
            v.cast("double").alias("revenue"),
            mean_of(F.sum(v).over(frame), F.count(v).over(frame)).alias("moving_avg_3m"),
        )
        .orderBy("year_month")
    )


def growth(s: Star, excluded=EXCLUDED) -> DataFrame:
    """Change against the previous month and against three months back."""
    by_month = calendar_window(order="month_start")
    rows = monthly_revenue(s, excluded).select(
        year_month("month_start").alias("month"),
        rounded("revenue").alias("revenue"),
        F.lag(rounded("revenue"), 1).over(by_month).alias("prev_month_revenue"),
        F.lag(rounded("revenue"), 3).over(by_month).alias("prev_quarter_revenue"),
    )
    return rows.select(
        "month",
        "revenue",
        "prev_month_revenue",
        growth_pct("revenue", "prev_month_revenue").alias("mom_growth_pct"),
        growth_pct("revenue", "prev_quarter_revenue").alias("qoq_growth_pct"),
    ).orderBy("month")


def category_months(s: Star, excluded=EXCLUDED) -> DataFrame:
    """Revenue per category and month, summed per product and month first."""
    per_product = (
        sold_items(s, excluded, "order_date")
        .groupBy("product_id", month_start("order_date").alias("month_start"))
        .agg(money_sum("revenue_units", 4).alias("revenue"))
    )
    return (
        per_product.join(s.products.select("product_id", "category"), "product_id")
        .groupBy("category", "month_start")
        .agg(F.sum("revenue").alias("revenue"))
    )


def cumulative_by_category(s: Star, excluded=EXCLUDED, limit: int | None = 50) -> DataFrame:
    upto = calendar_window("category", order="month_start")
    month = Window.partitionBy("month_start")
    rows = category_months(s, excluded).select(
        "category",
        year_month("month_start").alias("ym"),
        rounded("revenue").alias("monthly_revenue"),
        rounded(F.sum("revenue").over(upto)).alias("cumulative_revenue"),
        pct(F.col("revenue"), F.sum("revenue").over(month)).alias("monthly_share_pct"),
    )
    return top_k(rows, limit, F.asc("category"), F.asc("ym")) if limit else rows


def lifespans(s: Star, excluded=EXCLUDED, limit: int = 20) -> DataFrame:
    rows = customer_sales(s, excluded).select(
        "customer_id",
        "name",
        "first_order_date",
        "last_order_date",
        "total_orders",
        rounded("revenue").alias("total_spend"),
        days_between("last_order_date", "first_order_date")
        .cast("long")
        .alias("customer_lifespan_days"),
    )
    return top_k(rows, limit, F.desc("customer_lifespan_days"), F.asc("customer_id"))
