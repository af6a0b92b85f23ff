"""How facts are stored so that queries read and move less: buckets by key and partitions by month."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exprs import in_year, month_start
from millrace.sources.tables import Star

BUCKET_ROWS = 4 << 20
MONTH = "_month"


def bucket_count(df: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Buckets of about `rows` rows; a power of two, so that tables of different sizes still join bucket by bucket."""
    need = max(least, -(-df.count() // rows))
    return 1 << (need - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store `df` as a catalog table whose files hold the rows of one bucket of `key`, sorted; returns the table."""
    dealt = df.repartition(buckets, key)  # one file per bucket instead of one per task and bucket
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_star(s: Star, namespace: str, path: str, buckets: int | None = None) -> Star:
    """The star with orders and items bucketed alike by order: joins and sums per order need no shuffle of them.

    Worth it for tables that are joined more than once; storing them is the one shuffle.
    """
    n = buckets or bucket_count(s.items)
    orders = write_bucketed(s.orders, f"{namespace}.orders", f"{path}/orders", "order_id", n)
    items = write_bucketed(s.items, f"{namespace}.items", f"{path}/items", "order_id", n)
    return replace(s, orders=orders, items=items)


def write_monthly(df: DataFrame, date: str, path: str) -> DataFrame:
    """Store `df` in a folder per month of `date` (rows without a date in one of their own); returns what is stored."""
    cut = df.withColumn(MONTH, month_start(date))
    # Rows of a month come together, and adaptive execution splits a month that is too much for a task.
    cut.hint("rebalance", MONTH).write.mode("errorifexists").partitionBy(MONTH).parquet(path)
    return read_monthly(df.sparkSession, path)


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows and their month; the month is a date."""
    return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("date"))


def stored_in_year(date: str, year: int) -> Column:
    """`in_year` on rows stored by month: only that year's folders are opened."""
    return in_year(MONTH, year) & in_year(date, year)


def months_of(stored: DataFrame) -> DataFrame:
    """The calendar of a table stored by month: a row per folder, from the folders' names."""
    months = stored.select(MONTH).distinct().where(F.col(MONTH).isNotNull())
    return months.select(
        F.col(MONTH).alias("month"), F.year(MONTH).alias("year"), F.quarter(MONTH).alias("quarter"), F.month(MONTH).alias("month_of_year")
    )


def in_months(stored: DataFrame, calendar: DataFrame) -> DataFrame:
    """The stored rows whose month is in `calendar` (a filtered `months_of`).

    Which folders that means is known only when the calendar has been read; Spark then opens no others.
    """
    return stored.join(calendar.select(F.col("month").alias("_wanted")), F.col(MONTH) == F.col("_wanted")).drop("_wanted")
