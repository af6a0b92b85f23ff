"""Writers: files, catalog tables, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import rows_seen
from millrace.sources.files import CSV_FORMAT, NO_VALUE


PACKED_ROWS = 250_000  # rows of a compressed file at most, as only one task can read it


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> int:
    """CSV with header, overwrite, blanks kept; returns the rows written.

    NULL is a blank cell and an empty text a quoted one.  A NULL that is alone in its row is written out, as
    readers skip blank lines.  Plain text can be split by readers; with `compression` (a codec's name, like
    gzip) it cannot, so a task begins another file after `PACKED_ROWS` rows.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = watched.write.mode("overwrite").options(**CSV_FORMAT, nullValue=NO_VALUE if len(df.columns) == 1 else "")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return rows_seen(seen, df)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Parquet, overwrite; returns the rows written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return rows_seen(seen, df)


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> int:
    """Replace a catalog table, its schema included; returns the rows written.

    The count comes from the write itself instead of running the plan again.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return rows_seen(seen, df)


def analyze_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Statistics for the cost-based choices (join side, broadcast)."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def use_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema if it is missing and make it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")
    spark.sql(f"USE {name}")


def write_json_report(report: DataFrame, path: str) -> int:
    """A report table as JSON lines; a report has a handful of rows."""
    seen = Observation()
    watched = report.observe(seen, F.count(F.lit(1)).alias("rows"))
    watched.repartition(1).write.mode("overwrite").json(path)
    return rows_seen(seen, report)
