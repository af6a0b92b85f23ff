"""Frequency and spend segments, and recency/frequency/monetary scores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import bucketize, days_between, mean_of, rounded
from millrace.plans.commerce import (
    EXCLUDED,
    customer_sales,
    customer_totals,
    frequency_segment,
    order_frequency,
)
from millrace.sources.tables import Star

# Spend limits, score limits and labels.
SPEND_BOUNDS = (500, 2000)
SPEND_LABELS = ("Low", "Medium", "High")
SPEND_LONG_LABELS = ("Low Spender (<$500)", "Medium Spender ($500–$2000)", "High Spender (>$2000)")
SPEND_REPORT_LABELS = ("Low Spender", "Medium Spender", "High Spender")
RECENCY_BOUNDS = (30, 90, 180, 365)
FREQUENCY_BOUNDS = (2, 3, 6, 10)
MONETARY_BOUNDS = (500, 1000, 2000, 5000)
SEGMENT_FLOORS = (4, 7, 10, 13)
SEGMENTS = ("Lost", "Dormant", "At Risk", "Loyal Customers", "Champions")
REPORT_SEGMENTS = ("😴 Churned", "😴 Churned", "🔄 At Risk", "💎 Loyal", "🏆 Champions")


@dataclass(frozen=True)
class Scale:
    """Limits that depend on the currency and the size of the shop."""

    spend: tuple = SPEND_BOUNDS
    recency: tuple = RECENCY_BOUNDS
    frequency: tuple = FREQUENCY_BOUNDS
    monetary: tuple = MONETARY_BOUNDS
    labels: tuple = field(default=SEGMENTS)


def spend_tier(spend: Column | str, scale: Scale = Scale(), labels=SPEND_LABELS) -> Column:
    return bucketize(spend, scale.spend, labels, closed="left")


def frequency_summary(orders: DataFrame, excluded=EXCLUDED) -> DataFrame:
    return (
        order_frequency(orders, excluded)
        .groupBy(frequency_segment("order_count").alias("freq_segment"))
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            mean_of(F.sum("order_count"), F.count(F.lit(1))).alias("avg_orders"),
            F.min("order_count").alias("min_orders"),
            F.max("order_count").alias("max_orders"),
        )
        .orderBy(F.desc("num_customers"))
    )


def spend_summary(s: Star, excluded=EXCLUDED, scale: Scale = Scale()) -> DataFrame:
    tier = spend_tier("revenue", scale, SPEND_LONG_LABELS)
    return (
        customer_totals(s, excluded)
        .groupBy(tier.alias("spend_tier"))
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            mean_of(F.sum("revenue"), F.count(F.lit(1))).alias("avg_spend"),
            rounded(F.sum("revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("avg_spend"))
    )


def segment_matrix(s: Star, excluded=EXCLUDED, scale: Scale = Scale()) -> DataFrame:
    return (
        customer_totals(s, excluded)
        .groupBy(
            frequency_segment("total_orders").alias("freq_seg"),
            spend_tier("revenue", scale).alias("spend_tier"),
        )
        .agg(F.count(F.lit(1)).alias("num_customers"))
        .orderBy("freq_seg", "spend_tier")
    )


def _points(value: Column | str, bounds) -> Column:
    """1..5, one more for each bound reached."""
    return bucketize(value, bounds, (1, 2, 3, 4, 5), closed="left")


def rfm(s: Star, as_of: str, excluded=EXCLUDED, scale: Scale = Scale()) -> DataFrame:
    """Scores per customer; `as_of` stands in for today, so a run can be repeated."""
    base = customer_sales(s, excluded).select(
        "customer_id",
        "name",
        days_between(F.lit(as_of).cast("date"), F.col("last_order_date"))
        .cast("long")
        .alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.round("revenue", 2).alias("money"),
    )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (
        base.withColumns(
            {
                "r_score": bucketize("recency_days", scale.recency, (5, 4, 3, 2, 1)),
                "f_score": _points("frequency", scale.frequency),
                "m_score": _points("money", scale.monetary),
            }
        )
        .withColumn("rfm_total", total)
        .withColumn("rfm_segment", bucketize("rfm_total", SEGMENT_FLOORS, scale.labels, "left"))
        .withColumn("monetary", F.col("money").cast("double"))
        .select(
            "customer_id",
            "name",
            "recency_days",
            "frequency",
            "monetary",
            "r_score",
            "f_score",
            "m_score",
            "rfm_total",
            "rfm_segment",
            "money",
        )
    )


def rfm_scores(s: Star, as_of: str, excluded=EXCLUDED, scale: Scale = Scale()) -> DataFrame:
    return rfm(s, as_of, excluded, scale).drop("money").orderBy(F.desc("rfm_total"), "customer_id")


def rfm_summary(s: Star, as_of: str, excluded=EXCLUDED, scale: Scale = Scale()) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        rfm(s, as_of, excluded, scale)
        .groupBy("rfm_segment")
        .agg(
            n.alias("num_customers"),
            mean_of(F.sum("recency_days"), n, 1).alias("avg_recency_days"),
            mean_of(F.sum("frequency"), n, 1).alias("avg_frequency"),
            mean_of(F.sum("money"), n).alias("avg_monetary"),
            rounded(F.sum("money")).alias("segment_revenue"),
        )
        .orderBy(F.desc("avg_monetary"))
    )
