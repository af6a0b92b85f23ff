"""Monthly trend and leaders of the order-level shop tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import month_start, rounded, year_month
from millrace.operators.relational import top_k


def monthly_trend(orders: DataFrame, cancelled: str = "Cancelled") -> DataFrame:
    return (
        orders.where(F.col("status") != cancelled)
        .groupBy(month_start("order_date").alias("m"))
        .agg(F.count(F.lit(1)).alias("num_orders"), rounded(F.sum("amount")).alias("revenue"))
        .select(year_month("m").alias("month"), "num_orders", "revenue")
        .orderBy("month")
    )


def top_customers(
    orders: DataFrame, customers: DataFrame, cancelled: str = "Cancelled", limit: int = 3
) -> DataFrame:
    """`customers` has customer_id and customer_name."""
    spend = (
        orders.where(F.col("status") != cancelled)
        .groupBy("customer_id")
        .agg(rounded(F.sum("amount")).alias("total_spend"), F.count(F.lit(1)).alias("order_count"))
        .join(customers.select("customer_id", "customer_name"), "customer_id")
    )
    return top_k(
        spend.select("customer_id", "customer_name", "total_spend", "order_count"),
        limit,
        F.desc("total_spend"),
        F.asc("customer_id"),
    )


def top_products(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    cancelled: str = "Cancelled",
    limit: int = 3,
) -> DataFrame:
    sold = (
        items.join(orders.where(F.col("status") != cancelled).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("total_qty_sold"))
        .join(products.select("product_id", "product_name"), "product_id")
    )
    return top_k(
        sold.select("product_id", "product_name", "total_qty_sold"),
        limit,
        F.desc("total_qty_sold"),
        F.asc("product_id"),
    )


def country_summary(customers: DataFrame, country: str, amount: str) -> DataFrame:
    total = F.sum(amount)
    return (
        customers.groupBy(country)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.round(F.try_divide(total.cast("double"), F.count(amount)), 2).alias("avg_purchase"),
            rounded(total).alias("total_purchase"),
        )
        .orderBy(F.desc("customers"))
    )


def top_countries(customers: DataFrame, country: str, amount: str, limit: int = 8) -> DataFrame:
    rows = customers.groupBy(country).agg(rounded(F.sum(amount)).alias("total_purchase"))
    return top_k(rows, limit, F.desc("total_purchase"), F.asc(country))


def status_summary(df: DataFrame, status: str, amount: str) -> DataFrame:
    return df.groupBy(status).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.try_divide(F.sum(amount).cast("double"), F.count(amount)), 2).alias("avg_purchase"),
    )


def foreign_price_chain(products: DataFrame, category: str, rate: float = 84.0) -> DataFrame:
    """Filter, project, derive: one narrow stage over three columns."""
    return (
        products.where(F.col("category") == category)
        .select("product_id", "name", F.col("price").cast("double").alias("price"))
        .withColumn("price_in_usd", F.col("price") / F.lit(rate))
    )
