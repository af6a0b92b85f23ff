"""Named reports: name -> function of (star, options) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import growth_pct, mean_of, rounded, year_month
from millrace.operators.relational import check_limit, top_k
from millrace.operators.windows import calendar_window, ranks
from millrace.plans import cohort, commerce, segments
from millrace.plans.commerce import EXCLUDED, frequency_segment
from millrace.session import staged
from millrace.sources.tables import Star


@dataclass(frozen=True)
class Options:
    """What a report may be asked for; `as_of` is the day recency is counted from."""

    limit: int = 10
    as_of: str = "2001-09-01"
    excluded: tuple = EXCLUDED
    scale: segments.Scale = segments.Scale()


def revenue(s: Star, o: Options) -> DataFrame:
    return commerce.revenue_by_category(s, o.excluded).select(
        F.col("category").alias("Category"),
        F.col("num_orders").alias("Orders"),
        F.col("total_revenue").alias("Revenue"),
        F.col("avg_unit_price").alias("Avg_Unit_Price"),
    )


def top_customers(s: Star, o: Options) -> DataFrame:
    """Everyone ranked above a leader is a leader, so the rank may follow the limit."""
    top = top_k(
        commerce.customer_sales(s, o.excluded), o.limit, F.desc("revenue"), F.asc("customer_id")
    )
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("revenue"))
    return top.select(
        F.col("customer_id").alias("ID"),
        F.col("name").alias("Name"),
        F.col("city").alias("City"),
        F.col("total_orders").alias("Total_Orders"),
        rounded("revenue").alias("Lifetime_Value"),
        F.dense_rank().over(down).cast("long").alias("LTV_Rank"),
    ).orderBy(F.desc("Lifetime_Value"), "ID")


def top_products(s: Star, o: Options) -> DataFrame:
    """Sorted by revenue, ranked by quantity: the rank has to look at all products."""
    ranked = ranks(
        staged(commerce.product_totals(s, o.excluded)), [("units", True)], rank="Qty_Rank"
    )
    top = top_k(ranked, o.limit, F.desc("revenue"), F.asc("product_id"))
    return top.select(
        F.col("product_id").alias("ID"),
        F.col("name").alias("Product"),
        F.col("category").alias("Category"),
        F.col("units").alias("Qty_Sold"),
        rounded("revenue").alias("Revenue"),
        "Qty_Rank",
    ).orderBy(F.desc("Revenue"), "ID")


def monthly_revenue(s: Star, o: Options) -> DataFrame:
    value = rounded("revenue")
    previous = F.lag(value).over(calendar_window(order="month_start"))
    return (
        commerce.monthly_revenue(s, o.excluded)
        .select(
            year_month("month_start").alias("Month"),
            value.alias("Revenue"),
            growth_pct(value, previous).alias("Growth_Pct"),
        )
        .orderBy("Month")
    )


def aov(s: Star, o: Options) -> DataFrame:
    """Mean of the customers' own average order value per frequency and spend tier."""
    own = mean_of("revenue", "total_orders", None)
    return (
        commerce.customer_totals(s, o.excluded)
        .groupBy(
            frequency_segment("total_orders").alias("Segment"),
            segments.spend_tier("revenue", o.scale, segments.SPEND_REPORT_LABELS).alias("Spend_Tier"),
        )
        .agg(F.count(F.lit(1)).alias("Customers"), F.round(F.avg(own), 2).alias("Avg_Order_Value"))
        .orderBy(F.desc("Avg_Order_Value"))
    )


def retention(s: Star, o: Options) -> DataFrame:
    grid = cohort.retention_grid(s.orders, o.excluded).toDF(
        "Cohort", "Month", "Cohort_Size", "Active", "Retention_Pct"
    )
    return top_k(grid, 60, F.asc("Cohort"), F.asc("Month"))


def segmentation(s: Star, o: Options) -> DataFrame:
    value = F.round("revenue", 2)
    rows = commerce.customer_sales(s, o.excluded).select(
        F.col("customer_id").alias("ID"),
        F.col("name").alias("Name"),
        F.col("total_orders").alias("Orders"),
        value.cast("double").alias("Total_Spend"),
        F.col("last_order_date").alias("Last_Order"),
        frequency_segment("total_orders").alias("Frequency_Segment"),
        segments.spend_tier(value, o.scale).alias("Spend_Tier"),
    )
    return top_k(rows, 30, F.desc("Total_Spend"), F.asc("ID"))


def rfm(s: Star, o: Options) -> DataFrame:
    scale = replace(o.scale, labels=segments.REPORT_SEGMENTS)
    rows = segments.rfm(s, o.as_of, o.excluded, scale).select(
        F.col("customer_id").alias("ID"),
        F.col("name").alias("Name"),
        F.col("recency_days").cast("double").alias("Recency_Days"),
        F.col("frequency").alias("Frequency"),
        F.col("monetary").alias("Monetary"),
        F.col("r_score").alias("R"),
        F.col("f_score").alias("F"),
        F.col("m_score").alias("M"),
        F.col("rfm_total").alias("RFM_Total"),
        F.col("rfm_segment").alias("RFM_Segment"),
    )
    return top_k(rows, 25, F.desc("RFM_Total"), F.asc("ID"))


# The reports' names and titles.
REPORTS: dict[str, tuple[str, Callable[[Star, Options], DataFrame]]] = {
    "revenue": ("Total Revenue by Category", revenue),
    "top_customers": ("Top Customers by Lifetime Value", top_customers),
    "top_products": ("Top Products by Revenue", top_products),
    "monthly_revenue": ("Monthly Revenue with Growth %", monthly_revenue),
    "aov": ("Average Order Value by Segment", aov),
    "retention": ("Cohort Retention Analysis", retention),
    "segmentation": ("Customer Segmentation", segmentation),
    "rfm": ("RFM Analysis", rfm),
}


def run_report(name: str, s: Star, options: Options = Options()) -> dict[str, DataFrame]:
    """The report, or every report for `all`; unknown names and limits raise ValueError."""
    check_limit(options.limit)
    if name == "all":
        return {n: fn(s, options) for n, (_, fn) in REPORTS.items()}
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; choose from {', '.join([*REPORTS, 'all'])}")
    return {name: REPORTS[name][1](s, options)}


def report_index(s: Star, options: Options = Options()) -> DataFrame:
    """One row per report with its title and the number of rows it returns."""
    out = None
    for name, (title, fn) in REPORTS.items():
        one = fn(s, options).agg(F.count(F.lit(1)).alias("result_rows")).select(
            F.lit(name).alias("report"), F.lit(title).alias("title"), "result_rows"
        )
        out = one if out is None else out.unionByName(one)
    return out
