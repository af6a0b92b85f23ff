"""Questions on one flat sales table and on the tables split out of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import mean_of, money_sum, rounded
from millrace.operators.relational import above_average, rows_at_group_max, top_k
from millrace.operators.windows import Order, ranks, row_numbers, running_by_period
from millrace.session import staged
from millrace.sources.copying import split_dimension
from millrace.sources.tables import Star


def sales_rows(s: Star) -> DataFrame:
    """One row per sold line with its order's date and customer.

    `profit` is what is left of the sale above 95 % of the line's list value.
    """
    facts = s.items.select(
        "order_id",
        "line_number",
        "product_id",
        "supplier_id",
        F.col("revenue").alias("sales"),
        "quantity",
        "discount",
        (F.col("revenue") - F.col("gross") * F.lit(0.95).cast("decimal(3,2)"))
        .cast("decimal(18,4)")
        .alias("profit"),
        F.col("revenue_units").alias("sales_units"),
        (F.col("revenue_units") - F.col("gross_cents") * 95).alias("profit_units"),
    )
    return facts.join(s.orders.select("order_id", "order_date", "customer_id"), "order_id")


def flat_sales(s: Star) -> DataFrame:
    """The sales rows with customer and product attributes beside them."""
    segments = s.customers.select("customer_id", F.col("city").alias("segment"))
    goods = s.products.select(
        "product_id",
        F.col("name").alias("product_name"),
        "category",
        F.col("brand").alias("sub_category"),
    )
    return sales_rows(s).join(segments, "customer_id").join(goods, "product_id")


@dataclass(frozen=True)
class Split:
    customers: DataFrame
    products: DataFrame
    sales: DataFrame


def normalise(flat: DataFrame, order: Order) -> Split:
    """Customer and product dimensions plus the fact rows; first row per key wins."""
    return Split(
        split_dimension(flat, "customer_id", ["segment"], order),
        split_dimension(flat, "product_id", ["product_name", "category", "sub_category"], order),
        flat.drop("segment", "product_name", "category", "sub_category"),
    )


def overview(flat: DataFrame) -> DataFrame:
    """Per order first, then per customer, so nothing is counted distinctly; an order has one customer."""
    per_order = flat.groupBy("customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"), money_sum("sales_units", 4).alias("sales")
    )
    per_customer = per_order.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("n").alias("n"), F.sum("sales").alias("sales")
    )
    return per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.sum("orders"), F.lit(0).cast("long")).alias("orders"),
        rounded(F.sum("sales")).alias("total_sales"),
    )


def totals_by_customer(sales: DataFrame) -> DataFrame:
    """Sales, profit and distinct orders; per order first, so no distinct is needed."""
    return (
        sales.groupBy("customer_id", "order_id")
        .agg(
            money_sum("sales_units", 4).alias("sales"),
            money_sum("profit_units", 4).alias("profit"),
        )
        .groupBy("customer_id")
        .agg(
            F.sum("sales").alias("sales"),
            F.sum("profit").alias("profit"),
            F.count(F.lit(1)).alias("num_orders"),
        )
    )


def customer_sales(sales: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        totals_by_customer(sales)
        .join(customers.select("customer_id", "segment"), "customer_id")
        .select("customer_id", "segment", rounded("sales").alias("total_sales"), "num_orders")
        .orderBy(F.desc("total_sales"))
    )


def leaders(sales: DataFrame, limit: int = 5, bottom: bool = False) -> DataFrame:
    rows = totals_by_customer(sales).select("customer_id", rounded("sales").alias("total_sales"))
    first = F.asc("total_sales") if bottom else F.desc("total_sales")
    return top_k(rows, limit, first, F.asc("customer_id"))


def above_average_sales(sales: DataFrame) -> DataFrame:
    return above_average(sales, "sales").select(
        "order_id", "customer_id", rounded("sales").alias("sales")
    )


def biggest_sale_per_customer(sales: DataFrame) -> DataFrame:
    return rows_at_group_max(sales, "customer_id", "sales").select(
        "customer_id", "order_id", rounded("sales").alias("top_sale")
    )


def numbered_in_category(sales: DataFrame, products: DataFrame, ties: list[str]) -> DataFrame:
    """Row number per category by sales; a category holds a large part of all rows."""
    rows = sales.join(
        products.select("product_id", "product_name", "category"), "product_id"
    ).select("category", "product_name", "sales", *ties)
    order: Order = [("sales", True), *[(t, False) for t in ties]]
    return row_numbers(staged(rows), order, ["category"]).select(
        "category", "product_name", rounded("sales").alias("sales"), "row_num"
    )


def ranked_customers(sales: DataFrame) -> DataFrame:
    totals = staged(totals_by_customer(sales).select("customer_id", "sales"))
    return ranks(totals, [("sales", True)], rank="rank").select(
        "customer_id", rounded("sales").alias("total_sales"), "rank"
    )


def running_sales(sales: DataFrame) -> DataFrame:
    """Running total by date over the sales rows; rows of one day share the figure."""
    return running_by_period(sales, "order_date", money_sum("sales_units", 4), "total").select(
        "order_date",
        "order_id",
        rounded("sales").alias("sale"),
        rounded("total").alias("running_total"),
    )


def ranked_with_segment(sales: DataFrame, customers: DataFrame) -> DataFrame:
    totals = totals_by_customer(sales).select(
        "customer_id",
        F.col("num_orders").alias("orders"),
        F.round("sales", 2).alias("value"),
        rounded("profit").alias("total_profit"),
    )
    return (
        ranks(staged(totals), [("value", True)], rank="sales_rank")
        .join(customers.select("customer_id", "segment"), "customer_id")
        .select(
            "sales_rank",
            "customer_id",
            "segment",
            "orders",
            F.col("value").cast("double").alias("total_sales"),
            "total_profit",
        )
        .orderBy("sales_rank")
    )


def single_order_customers(sales: DataFrame) -> DataFrame:
    return totals_by_customer(sales).where("num_orders = 1").select("customer_id", "num_orders")


def big_spenders(sales: DataFrame) -> DataFrame:
    """Customers above the average of the customer totals."""
    totals = totals_by_customer(sales).select("customer_id", F.round("sales", 2).alias("value"))
    return (
        above_average(staged(totals), "value")
        .select("customer_id", F.col("value").cast("double").alias("total_sales"))
        .orderBy(F.desc("total_sales"))
    )


def _by_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        money_sum("sales_units", 4).alias("sales"), money_sum("profit_units", 4).alias("profit")
    )


def category_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _by_product(sales)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            rounded(F.sum("sales")).alias("total_sales"),
            rounded(F.sum("profit")).alias("total_profit"),
        )
        .orderBy(F.desc("total_sales"))
    )


def top_sub_categories(sales: DataFrame, products: DataFrame, limit: int = 8) -> DataFrame:
    rows = (
        _by_product(sales)
        .join(products.select("product_id", "sub_category"), "product_id")
        .groupBy("sub_category")
        .agg(rounded(F.sum("profit")).alias("total_profit"))
    )
    return top_k(rows, limit, F.desc("total_profit"), F.asc("sub_category"))


def region_average(flat: DataFrame, region_col: str, region, category: str, value: str) -> DataFrame:
    return (
        flat.where(F.col(region_col) == region)
        .groupBy(category)
        .agg(mean_of(F.sum(value), F.count(value)).alias("average_sales"))
    )


def frequent_groups(df: DataFrame, group: str, more_than: int = 100) -> DataFrame:
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .where(F.col("record_count") > more_than)
        .orderBy(F.desc("record_count"))
    )


def region_revenue(flat: DataFrame, region: str, sales: str) -> DataFrame:
    """Distinct rows, NULL sales as 0, revenue per region."""
    return (
        flat.dropDuplicates()
        .na.fill({sales: 0})
        .groupBy(region)
        .agg(rounded(F.sum(sales)).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"))
    )
