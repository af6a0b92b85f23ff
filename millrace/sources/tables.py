"""The test tables, bound to the entities the plans work on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exprs import MONEY, RATE, cents, line_revenue


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(col: str):
    """The date columns are midnight timestamps."""
    return F.col(col).cast("date")


@dataclass(frozen=True)
class Star:
    """customers <- orders <- items -> products, under one set of column names."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("country"),
        F.col("c_acctbal").cast(MONEY).alias("balance"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        F.col("p_size").alias("stock"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("gross"),
        F.col("l_discount").cast(RATE).alias("discount"),
        line_revenue("l_extendedprice", "l_discount").alias("revenue"),
        # The same two amounts as whole cents and ten-thousandths, for sums.
        cents("l_extendedprice").alias("gross_cents"),
        (cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))).alias("revenue_units"),
        day("l_shipdate").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(
        customers(spark, sf_dir), products(spark, sf_dir), orders(spark, sf_dir), items(spark, sf_dir)
    )
