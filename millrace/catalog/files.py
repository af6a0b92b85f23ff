"""Readers, writers, snapshot tables and the conditional copy.

Each query writes what it needs to a new folder below the shared scratch folder and
returns what it reads back, so the statement to match is the one on the source table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import dirt
from millrace.catalog.quality import REPORT_SQL, SALES_FILE_SQL, SUMMARY_SQL, raw, sales_csv, sales_file, sales_report
from millrace.catalog.registry import in_namespace, money, query, star
from millrace.operators import quality as Q
from millrace.operators.cleaning import drop_null, latest_per_key
from millrace.plans import superstore
from millrace.session import scratch_dir, staged
from millrace.sources import copying, files, schemas, sinks, snapshots, tables


# Some names get quotes, a comma and a line break, some are empty and some missing; both engines read the rule.
_NAME = """CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat('"', c_name, '", the', chr(10), '"first"') WHEN c_custkey % 5 = 0
    THEN concat(c_name, ' "jr", Lee') ELSE c_name END"""
_CUSTOMERS = f"SELECT c_custkey, {_NAME} AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customer_csv(spark, sf):
    path = scratch_dir(spark, "customer-csv")
    rows = tables.load(spark, sf, "customer").withColumn("c_name", F.expr(_NAME))
    sinks.write_csv(rows.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    return path


# --- readers ----------------------------------------------------------------------


@query("src_csv_infer", _CUSTOMERS)
def src_csv_infer(spark, sf):
    df = files.read_csv_inferred(spark, _customer_csv(spark, sf))
    return df.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("src_csv_multiline", "SELECT doc_id, md5(text) AS text_md5, length(text) AS chars, lang FROM documents")
def src_csv_multiline(spark, sf):
    """Texts with line breaks and quotes survive the round trip."""
    path = scratch_dir(spark, "documents-csv")
    docs = tables.load(spark, sf, "documents").select("doc_id", "text", "lang")
    sinks.write_csv(docs, path)
    back = files.read_csv_typed(spark, path, "doc_id long, text string, lang string")
    return back.select(
        "doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("chars"), "lang"
    )


@query(
    "src_csv_strings",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
        CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM ({_CUSTOMERS})""",
)
def src_csv_strings(spark, sf):
    return files.read_csv_strings(spark, _customer_csv(spark, sf))


@query(
    "src_csv_schema",
    f"""WITH {raw('products')} SELECT TRY_CAST(product_id AS BIGINT) AS product_id, name, category,
        TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(stock_qty AS INTEGER) AS stock_qty,
        (product_id IS NOT NULL AND TRY_CAST(product_id AS BIGINT) IS NULL)
        OR (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) AS malformed FROM raw_products""",
)
def src_csv_schema(spark, sf):
    path = scratch_dir(spark, "products-csv")
    rows = dirt.frame(spark, sf, dirt.RAW_PRODUCTS).drop("created_at", "supplier_id")
    sinks.write_csv(rows, path)
    typed = files.read_csv_typed(
        spark, path, "product_id long, name string, category string, price double, stock_qty int", "bad_line"
    )
    return typed.withColumn("malformed", F.col("bad_line").isNotNull()).drop("bad_line")


@query("src_parquet", "SELECT * FROM orders")
def src_parquet(spark, sf):
    return files.read_parquet(spark, f"{sf}/orders.parquet")


@query(
    "src_rows",
    """SELECT m.label, count(*) AS orders FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'))
        m(code, label) ON m.code = o_orderstatus GROUP BY m.label""",
)
def src_rows(spark, sf):
    """Typed literal rows as master data beside the orders."""
    states = files.rows_to_table(
        spark, [("F", "finished"), ("O", "open"), ("P", "pending")], "status string, label string"
    )
    counts = tables.orders(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(states, "status").select("label", "orders")


@query("src_table", "SELECT * FROM supplier")
def src_table(spark, sf):
    def work(name, path):
        sinks.overwrite_table(tables.load(spark, sf, "supplier"), f"{name}.supplier_master", f"{path}/suppliers")
        sinks.analyze_table(spark, f"{name}.supplier_master", ["s_suppkey"])
        return spark.table(f"{name}.supplier_master")

    return in_namespace(spark, "care", work)


_BY_TYPE = """SELECT p_type, count(*) AS products, CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS list_value
    FROM {part} GROUP BY p_type"""


@query("src_view_sql", _BY_TYPE.format(part="part"))
def src_view_sql(spark, sf):
    """SQL over a frame that is named for this statement only."""
    return spark.sql(_BY_TYPE, part=tables.load(spark, sf, "part"))


@query("src_namespace", "SELECT n_name, n_regionkey FROM nation")
def src_namespace(spark, sf):
    """The unqualified name is found because the namespace is current."""

    def work(name, path):
        sinks.overwrite_table(tables.load(spark, sf, "nation"), "nation_master", f"{path}/nations")
        return spark.table(f"{spark.catalog.currentDatabase()}.nation_master").select(
            "n_name", "n_regionkey"
        )

    return in_namespace(spark, "geo", work)


# One file per region and 10,000 customer keys, its lines in a fixed order, so that a statement can rebuild every byte.
_KEYS_A_FILE = 10_000
_REGION_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_REGION_FILES = f"""regions AS (SELECT 'part=' || n_regionkey || '-' || (c_custkey // {_KEYS_A_FILE}) AS folder, c_custkey,
        concat_ws('|', CAST(c_custkey AS STRING), c_name, CAST(c_nationkey AS STRING), c_mktsegment) AS line
        FROM customer JOIN nation ON n_nationkey = c_nationkey),
    bodies AS (SELECT folder, '{'|'.join(_REGION_COLUMNS)}' || chr(10) || string_agg(line, chr(10) ORDER BY c_custkey) || chr(10) AS body,
        count(*) + 1 AS lines FROM regions GROUP BY folder)"""
_SPARK_TYPES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>' ELSE data_type END"""
_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def _region_files(spark, sf):
    path = scratch_dir(spark, "regions")
    people = tables.load(spark, sf, "customer").join(
        tables.load(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    part = F.concat_ws("-", "n_regionkey", F.floor(F.col("c_custkey") / _KEYS_A_FILE))
    rows = people.select(part.alias("part"), *_REGION_COLUMNS)
    dealt = rows.repartition("part").sortWithinPartitions("part", "c_custkey")
    dealt.write.options(header=True, sep="|").partitionBy("part").csv(path)
    return path


@query(
    "src_file_metadata",
    f"""WITH {_REGION_FILES} SELECT true AS file_exists, folder, 'File' AS item_type, 'csv' AS extension,
        CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes, {len(_REGION_COLUMNS)} AS column_count,
        'struct<{','.join(f'{c}:string' for c in _REGION_COLUMNS)}>' AS structure FROM bodies
        UNION ALL SELECT true, table_name, 'File', 'parquet', NULL, CAST(count(*) AS INTEGER),
        'struct<' || string_agg(column_name || ':' || {_SPARK_TYPES}, ',' ORDER BY ordinal_position) || '>'
        FROM information_schema.columns WHERE table_name IN ({', '.join(f"'{t}'" for t in _TABLES)}) GROUP BY table_name""",
)
def src_file_metadata(spark, sf):
    """Facts and structure of the region files, and the structure of every table's files, as a footer says it.

    SQL cannot see the size of a table's file, so only that of the region files is given.
    """
    made = files.file_metadata(spark, _region_files(spark, sf), "*.csv", "|").drop("item_name", "last_modified")
    found = files.file_metadata(spark, sf, "*.parquet")
    table = F.array_join(F.filter(F.array("folder", "item_name"), lambda x: x.endswith(".parquet")), "/")
    name = F.regexp_extract(table, r"^([^./]+)\.parquet", 1)
    stored = found.select("file_exists", name.alias("folder"), "item_type", "extension", "column_count", "structure").distinct()
    return made.unionByName(stored, allowMissingColumns=True)


@query(
    "src_file_md5",
    f"""WITH {_REGION_FILES} SELECT folder, CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes, md5(body) AS md5,
        lines FROM bodies""",
)
def src_file_md5(spark, sf):
    path = _region_files(spark, sf)
    sums = files.file_md5(spark, path, "*.csv").drop("item_name")
    return sums.join(files.text_fingerprint(spark, path, "*.csv").select("folder", "lines"), "folder")


# --- writers -----------------------------------------------------------------------------


@query("sink_csv", _CUSTOMERS)
def sink_csv(spark, sf):
    return files.read_csv_typed(
        spark,
        _customer_csv(spark, sf),
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )


@query("sink_parquet", star("SELECT order_id, customer_id, order_date, status FROM ord"))
def sink_parquet(spark, sf):
    path = scratch_dir(spark, "orders")
    rows = tables.orders(spark, sf).select("order_id", "customer_id", "order_date", "status")
    sinks.write_parquet(rows, path, ["status"])
    return files.read_parquet(spark, path)


@query(
    "sink_table_overwrite",
    star("SELECT customer_id, name, country, (SELECT count(*) FROM cust) AS rows_written FROM cust"),
)
def sink_table_overwrite(spark, sf):
    """Written twice, the second time with another column: the table follows."""

    def work(name, path):
        rows = tables.customers(spark, sf)
        sinks.overwrite_table(rows.select("customer_id", "name"), f"{name}.customer_master", f"{path}/customers")
        n = sinks.overwrite_table(rows.select("customer_id", "name", "country"), f"{name}.customer_master", f"{path}/customers")
        return spark.table(f"{name}.customer_master").withColumn("rows_written", F.lit(n).cast("long"))

    return in_namespace(spark, "shop", work)


def _publish_lines(spark, sf):
    """Raw lines as version 0, then the table cleaned over itself as version 1."""
    root = scratch_dir(spark, "lines")
    lines = tables.items(spark, sf).select(
        "order_id", "line_number", "product_id", "supplier_id", "quantity", "ship_date"
    )
    snapshots.publish(lines, root, "WRITE")
    known = drop_null(snapshots.read(spark, root), ["order_id", "line_number"])
    latest = latest_per_key(
        known, ["order_id", "line_number"], "ship_date", ["product_id", "supplier_id", "quantity"]
    )
    snapshots.publish(latest, root, "CLEAN")
    return root


_CLEANED = """SELECT order_id, line_number, product_id, supplier_id, quantity, ship_date FROM item
    QUALIFY row_number() OVER (PARTITION BY order_id, line_number
    ORDER BY ship_date DESC, product_id DESC, supplier_id DESC, quantity DESC) = 1"""


@query("sink_snapshot", star(_CLEANED))
def sink_snapshot(spark, sf):
    return snapshots.read(spark, _publish_lines(spark, sf))


@query(
    "tbl_history",
    star(f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS row_count FROM item
        UNION ALL SELECT 1, 'CLEAN', count(*) FROM ({_CLEANED})"""),
)
def tbl_history(spark, sf):
    log = snapshots.history(spark, _publish_lines(spark, sf))
    return log.select("version", "operation", "row_count")


@query(
    "sink_json_report",
    star(f"""{SALES_FILE_SQL}, {REPORT_SQL}, figures AS ({SUMMARY_SQL})
        SELECT check_name, passed, observed, expected, (SELECT bool_and(passed) FROM report) AS all_passed,
        '' AS missing_columns, '' AS extra_columns, figures.* FROM report, figures"""),
)
def sink_json_report(spark, sf):
    """The validation report as one JSON document, read back with a row per check."""
    path = scratch_dir(spark, "report")
    rows, size = sales_csv(spark, sf)
    summary = Q.summary_stats(rows, "Sales", "Profit")
    document = Q.report_document(sales_report(rows, size), rows.columns, schemas.SALES_FILE_COLUMNS, summary)
    sinks.write_json_report(document, path)
    back = spark.read.schema(document.schema).json(path)
    return back.select(
        F.col("passed").alias("all_passed"), "missing_columns", "extra_columns", F.inline("checks"), "summary.*"
    )


# --- jobs -----------------------------------------------------------------------------------


_TYPED = ", ".join(
    f'TRY_CAST("{c}" AS {schemas.SALES_FILE_TYPES[c]}) AS "{c}"' if c in schemas.SALES_FILE_TYPES else f'"{c}"'
    for c in schemas.SALES_FILE_COLUMNS
)


@query(
    "pipe_conditional_copy",
    star(f"""{SALES_FILE_SQL} SELECT {_TYPED}, (SELECT count(*) FROM file) AS rows_copied,
        (SELECT count(*) FROM file WHERE TRY_CAST("Sales" AS DOUBLE) IS NULL) AS rows_malformed FROM file"""),
)
def pipe_conditional_copy(spark, sf):
    """The sales file, then its typed copy to a stamped target, all columns.

    The file to be copied is kept compressed; the target is plain text, as the copy's contract has it.
    """
    source, folder = scratch_dir(spark, "sales-file"), scratch_dir(spark, "processed")
    sinks.write_csv(sales_file(spark, sf), source, "gzip")
    done = copying.conditional_copy(
        spark, source, folder, schemas.SALES_FILE, "superstore", "20010901_000000"
    )
    copied = files.read_csv_typed(spark, done.target, schemas.SALES_FILE)
    return copied.withColumns(
        {
            "rows_copied": F.lit(done.rows_copied).cast("long"),
            "rows_malformed": F.lit(done.rows_malformed).cast("long"),
        }
    )


@query(
    "pipe_normalise",
    star(f"""SELECT 'customer' AS part, customer_id AS id, segment AS label, count(*) AS sales_rows FROM flat GROUP BY 2, 3
        UNION ALL SELECT 'product', product_id, concat_ws('/', product_name, category, sub_category), count(*)
        FROM flat GROUP BY 2, 3"""),
)
def pipe_normalise(spark, sf):
    """Both dimensions with the number of fact rows that point to each key."""
    flat = staged(superstore.flat_sales(tables.star(spark, sf)))
    order = [(c, False) for c in ("order_id", "line_number", "product_id", "supplier_id", "quantity")]
    split = superstore.normalise(flat, order)
    uses = lambda key: split.sales.groupBy(key).agg(F.count(F.lit(1)).alias("sales_rows"))
    people = split.customers.join(uses("customer_id"), "customer_id").select(
        F.lit("customer").alias("part"), F.col("customer_id").alias("id"),
        F.col("segment").alias("label"), "sales_rows",
    )
    goods = split.products.join(uses("product_id"), "product_id").select(
        F.lit("product").alias("part"), F.col("product_id").alias("id"),
        F.concat_ws("/", "product_name", "category", "sub_category").alias("label"), "sales_rows",
    )
    return people.unionByName(goods)


@query(
    "src_format_compare",
    """SELECT 'csv' AS format, count(*) AS row_count FROM orders UNION ALL SELECT 'parquet', count(*) FROM orders""",
)
def src_format_compare(spark, sf):
    """The same rows written and counted in both formats; the bench times the reads."""
    rows = tables.load(spark, sf, "orders")
    csv, parquet = scratch_dir(spark, "orders-csv"), scratch_dir(spark, "orders-parquet")
    sinks.write_csv(rows, csv)
    sinks.write_parquet(rows, parquet)
    counted = Q.table_counts(
        {"csv": files.read_csv_strings(spark, csv), "parquet": files.read_parquet(spark, parquet)}
    )
    return counted.withColumnRenamed("tbl", "format")


@query(
    "clean_parquet_to_csv",
    star("""SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) * 1.18::DOUBLE AS final_price FROM ord
        WHERE order_id % 17 <> 0"""),
)
def clean_parquet_to_csv(spark, sf):
    """Parquet in, rows without a user out, CSV written and read back."""
    parquet, csv = scratch_dir(spark, "input"), scratch_dir(spark, "output")
    user = F.when(F.col("order_id") % 17 != 0, F.col("customer_id"))
    rows = tables.orders(spark, sf).select(
        "order_id", user.alias("customer_id"), "status",
        (F.col("amount").cast("double") * F.lit(1.18)).alias("final_price"),
    )
    sinks.write_parquet(rows, parquet)
    sinks.write_csv(drop_null(files.read_parquet(spark, parquet), ["customer_id"]), csv)
    return files.read_csv_typed(
        spark, csv, "order_id long, customer_id long, status string, final_price double"
    )
