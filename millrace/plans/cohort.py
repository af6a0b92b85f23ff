"""Retention by first-order month.

All queries start from one row per customer holding the set of days with an order.
The set is bounded by the calendar, not by the number of orders, and it is the only
large shuffle: months, offsets and the month-1 test are array expressions on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.exprs import days_between, month_offset, month_start, pct, year_month
from millrace.plans.commerce import EXCLUDED, counted


def active_days(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """customer_id, days, first_day, cohort (first day of the first month)."""
    return (
        counted(orders, excluded)
        .where(F.col("order_date").isNotNull())
        .groupBy("customer_id")
        .agg(F.collect_set("order_date").alias("days"))
        .withColumn("first_day", F.array_min("days"))
        .withColumn("cohort", month_start("first_day"))
    )


def cohort_sizes(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    first = (
        counted(orders, excluded)
        .where(F.col("order_date").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_day"))
    )
    return (
        first.groupBy(month_start("first_day").alias("m"))
        .agg(F.count(F.lit(1)).alias("cohort_size"))
        .select(year_month("m").alias("cohort_month"), "cohort_size")
        .orderBy("cohort_month")
    )


def retention_grid(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """Active customers per cohort and month.

    Everybody is active in the own first month, so that cell is the cohort size.
    """
    months = F.array_distinct(F.transform("days", lambda d: month_start(d)))
    cells = (
        active_days(orders, excluded)
        .select("cohort", F.explode(months).alias("month"))
        .groupBy("cohort", "month")
        .agg(F.count(F.lit(1)).alias("active"))
    )
    size = F.max(F.when(F.col("month") == F.col("cohort"), F.col("active"))).over(
        Window.partitionBy("cohort")
    )
    return cells.select(
        year_month("cohort").alias("cohort_month"),
        year_month("month").alias("activity_month"),
        size.alias("cohort_size"),
        F.col("active").alias("active_customers"),
        pct(F.col("active"), size).alias("retention_pct"),
    ).orderBy("cohort_month", "activity_month")


def retention_by_offset(orders: DataFrame, excluded=EXCLUDED, last: int = 12) -> DataFrame:
    """Active customers per cohort and 30-day period since the own first order."""
    offsets = F.array_distinct(
        F.transform("days", lambda d: month_offset(days_between(d, F.col("first_day"))))
    )
    cells = (
        active_days(orders, excluded)
        .select("cohort", F.explode(offsets).alias("month_offset"))
        .where(F.col("month_offset") <= last)
        .groupBy("cohort", "month_offset")
        .agg(F.count(F.lit(1)).alias("active"))
    )
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active"))).over(
        Window.partitionBy("cohort")
    )
    return cells.select(
        year_month("cohort").alias("cohort_month"),
        "month_offset",
        size.alias("cohort_size"),
        "active",
        pct(F.col("active"), size).alias("retention_pct"),
    ).orderBy("cohort_month", "month_offset")


def churn(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """One-time against repeat buyers with their share."""
    per_customer = counted(orders, excluded).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    groups = per_customer.groupBy(
        F.when(F.col("n") == 1, "Churned (one-time)").otherwise("Repeat Buyer").alias("customer_type")
    ).agg(F.count(F.lit(1)).alias("num_customers"))
    whole = F.sum("num_customers").over(Window.partitionBy(F.lit(0)))
    return groups.withColumn("pct_of_total", pct(F.col("num_customers"), whole)).orderBy(
        F.desc("num_customers")
    )


def month_one(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """Customers with an order 15 to 45 days after the cohort month began, in another month."""
    back = F.exists(
        "days",
        lambda d: (F.abs(days_between(d, F.col("cohort")) - 30) <= 15)
        & (month_start(d) != F.col("cohort")),
    )
    return (
        active_days(orders, excluded)
        .groupBy("cohort")
        .agg(F.count(F.lit(1)).alias("cohort_size"), F.count_if(back).alias("month1_active"))
        .select(
            year_month("cohort").alias("cohort_month"),
            "cohort_size",
            "month1_active",
            pct("month1_active", "cohort_size").alias("month1_retention_pct"),
        )
        .orderBy("cohort_month")
    )
