import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import merge as M
from millrace.operators import relational as R
from millrace.operators.cleaning import drop_duplicate_rows, latest_per_key
from millrace.operators.quality import Rules, apply_rules
from millrace.catalog import QUERIES
from millrace.catalog.quality import sales_file
from millrace.catalog.relational import agg_count_distinct
from millrace.plans import commerce, reports, shop, superstore
from millrace.session import _CREATED, clean_up, scratch_count, scratch_dir
from millrace.sources import copying, files, schemas, sinks, snapshots, tables
from millrace.streaming.incremental import merge_batch, upsert_files

SCHEMA = "id string, name string, amount double, stamp string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def master(spark):
    """22 rows, 20 keys: one exact copy and one key with two dates."""
    base = [(f"C{i:02d}", f"n{i}", float(i), "2024-01-01") for i in range(20)]
    return spark.createDataFrame(base + [base[3], ("C05", "newer", 50.0, "2024-02-01")], SCHEMA)


def increment(spark):
    changed = [(f"C{i:02d}", f"u{i}", i * 10.0, "2024-03-01") for i in range(6)]
    fresh = [(f"N{i}", f"f{i}", 1.0, "2024-03-01") for i in range(6)]
    return spark.createDataFrame(changed + fresh, SCHEMA)


def test_upsert_counts(spark):
    clean = latest_per_key(drop_duplicate_rows(master(spark)), ["id"], "stamp")
    assert (master(spark).count(), clean.count()) == (22, 20)
    merged = M.upsert(clean, increment(spark), ["id"])
    assert merged.count() == 26
    assert merged.select("id").distinct().count() == 26
    assert rows(merged.where("id = 'C05'"), "name", "amount") == [("u5", 50.0)]
    again = M.upsert(merged, increment(spark), ["id"])
    assert rows(again) == rows(merged)
    tags = M.tag_changes(clean, increment(spark), ["id"]).groupBy("operation").count()
    assert rows(tags) == [("INSERT", 6), ("UPDATE", 6)]
    assert rows(M.merge_counts(clean, increment(spark), ["id"])) == [(20, 6, 6, 26)]


def test_partial_update_keeps_the_other_columns(spark):
    target = spark.createDataFrame([("a", "x", 1.0, "s")], SCHEMA)
    source = spark.createDataFrame([("a", 9.0), ("b", 8.0)], "id string, amount double")
    assert rows(M.upsert(target, source, ["id"], ["amount"])) == [
        ("a", "x", 9.0, "s"), ("b", None, 8.0, None)
    ]


def test_duplicate_source_key_raises(spark):
    twice = increment(spark).unionByName(increment(spark).limit(1))
    with pytest.raises(Exception, match="more than one row for a key"):
        M.upsert(master(spark), twice, ["id"]).count()


def batch(spark, quantity, customer=1, order=2, product=6):
    orders = spark.createDataFrame([(1, 1)], "order_id long, customer_id long")
    items = spark.createDataFrame([(1, 5, 1)], "order_id long, product_id long, quantity long")
    stock = spark.createDataFrame([(5, 10), (6, 10)], "product_id long, stock long")
    new_orders = spark.createDataFrame([(order, customer)], "order_id long, customer_id long")
    new_items = spark.createDataFrame([(order, 5, quantity), (order, product, 1)], items.schema)
    people = spark.createDataFrame([(1,)], "customer_id long")
    return M.apply_order_batch(
        orders, items, stock, new_orders, new_items,
        Rules(foreign={"customer_id": (people, "customer_id")}),
        Rules(checks={"quantity": F.col("quantity") > 0}),
    )


def test_batch_applies_as_a_whole(spark):
    orders, items, stock = batch(spark, 4)
    assert (orders.count(), items.count(), rows(stock)) == (2, 3, [(5, 6), (6, 9)])


@pytest.mark.parametrize("fault", [{"quantity": 0}, {"customer": 999}, {"quantity": 11}, {"order": 1}, {"product": 5}])
def test_batch_with_a_fault_changes_nothing(spark, fault):
    """A broken rule, too little stock, an order that is stored already, an item that comes twice."""
    orders, items, stock = batch(spark, **{"quantity": 4, **fault})
    assert (orders.count(), items.count(), rows(stock)) == (1, 1, [(5, 10), (6, 10)])


def test_tables_share_a_commit(spark):
    root = scratch_dir(spark, "shop")
    a, b = spark.range(3), spark.range(5)
    snapshots.publish_all({"a": a, "b": b}, root, "FIRST")
    snapshots.publish_all({"a": b, "b": a}, root, "SECOND")
    log = [(r.version, r.operation, r.row_count) for r in snapshots.history(spark, root).collect()]
    assert log == [(1, "SECOND", 8), (0, "FIRST", 8)]
    assert snapshots.read_table(spark, root, "a").count() == 5
    assert snapshots.read_table(spark, root, "a", 0).count() == 3


def test_exact_copies_of_a_key_are_rejected(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], "id long, t string")
    tagged = apply_rules(df, Rules(unique={"id": (["id"], ["id"])}))
    assert rows(tagged.selectExpr("id", "t", "size(reasons)")) == sorted(
        [(1, "a", 0), (1, "a", 1), (1, "b", 1), (2, "c", 0), (None, "d", 0), (None, "d", 0)], key=str
    )


def test_snapshot_is_rebuilt_from_itself(spark):
    root = scratch_dir(spark, "snap")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    snapshots.publish(master(spark), root, "WRITE")
    snapshots.publish(latest_per_key(snapshots.read(spark, root), ["id"], "stamp"), root, "CLEAN")
    snapshots.publish(M.upsert(snapshots.read(spark, root), increment(spark), ["id"]), root, "MERGE")
    log = snapshots.history(spark, root)
    assert [(r.version, r.operation, r.row_count) for r in log.collect()] == [
        (2, "MERGE", 26), (1, "CLEAN", 20), (0, "WRITE", 22)
    ]
    assert snapshots.read(spark, root, 0).count() == 22


def test_files_left_by_a_dead_writer_are_not_seen(spark):
    root = scratch_dir(spark, "snap")
    snapshots.publish(master(spark), root, "WRITE")
    increment(spark).write.parquet(f"{root}/v=1")
    assert snapshots.read(spark, root).count() == 22
    assert snapshots.publish(increment(spark), root, "WRITE") == 2
    assert snapshots.read(spark, root).count() == 12


def test_stream_merges_each_batch_once(spark):
    source, root, ck = (scratch_dir(spark, x) for x in ("in", "table", "ck"))
    master(spark).coalesce(1).write.parquet(source)
    args = (spark, source, SCHEMA, root, ck, ["id"], "stamp", ["name", "amount"])
    upsert_files(*args).awaitTermination(120)
    assert snapshots.read(spark, root).count() == 20
    increment(spark).coalesce(1).write.mode("append").parquet(source)
    upsert_files(*args).awaitTermination(120)
    assert snapshots.read(spark, root).count() == 26
    version = snapshots.current_version(spark, root)
    merge_batch(increment(spark), 1, root, ["id"], "stamp", [])
    assert snapshots.current_version(spark, root) == version


def test_every_file_of_a_folder_has_a_structure(spark, sf):
    """Footers say what Spark's own reader says of each table."""
    facts = {r["item_name"].split(".")[0]: r for r in files.file_metadata(spark, sf, "*.parquet").collect()}
    assert len(facts) == 14
    for name, r in facts.items():
        schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
        assert (r["column_count"], r["structure"]) == (len(schema.fields), schema.simpleString())


def test_structure_of_text_files(spark, tmp_path):
    texts = {"e.csv": "\n\n", "a.csv": '\ufeffx,"two, ""q""\nlines",z\n1,2,3\n', "b.csv": "", "c.csv": "\n\nonly", "d.csv": "x" * 100_000 + ",y\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    got = {r["item_name"]: (r["column_count"], r["structure"]) for r in files.file_metadata(spark, str(tmp_path), "*.csv").collect()}
    assert got == {
        "a.csv": (3, 'struct<x:string,two, "q"\nlines:string,z:string>'),  # b.csv is empty, so not listed
        "e.csv": (None, None), "c.csv": (1, "struct<only:string>"), "d.csv": (2, f"struct<{'x' * 100_000}:string,y:string>"),
    }
    assert files.file_metadata(spark, str(tmp_path), "*.none").count() == 0


@pytest.mark.parametrize("row_bytes, piece", [(1 << 20, 7), (1000, 7), (0, 1 << 20)])
def test_md5_of_files_of_any_size(spark, tmp_path, row_bytes, piece):
    """Small files as rows, large ones in pieces: the same digests."""
    import hashlib

    bodies = {f"{n}.bin": bytes(i * 7 % 256 for i in range(n)) for n in (1, 6, 7, 8, 999, 1000, 1001, 50_000)}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    got = rows(files.file_md5(spark, str(tmp_path), "*.bin", row_bytes, piece), "item_name", "size_bytes", "md5")
    assert got == sorted([(n, len(b), hashlib.md5(b).hexdigest()) for n, b in bodies.items()], key=str)


def test_a_fingerprint_sees_changed_lines(spark):
    prints = []
    for lines in (["a", "b", "b"], ["b", "a", "b"], ["a", "b"], ["a", "b", "c"]):
        path = scratch_dir(spark, "lines")
        spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
        prints.append(files.text_fingerprint(spark, path, "*.txt").first()["fingerprint"])
    assert prints[0] == prints[1] and len(set(prints)) == 3


def test_a_late_row_changes_nothing(spark):
    root = scratch_dir(spark, "table")
    merge = lambda n, *rows_: merge_batch(spark.createDataFrame(rows_, SCHEMA), n, root, ["id"], "stamp", [])
    merge(0, ("a", "x", 1.0, "2024-02-01"), ("b", "x", 1.0, "2024-02-01"))
    merge(1, ("a", "late", 2.0, "2024-01-01"), ("b", "new", 2.0, "2024-03-01"), ("c", "first", 3.0, "2023-01-01"))
    assert rows(snapshots.read(spark, root), "id", "name") == [("a", "x"), ("b", "new"), ("c", "first")]


def test_price_chain_is_one_narrow_scan(spark, sf):
    plan = shop.foreign_price_chain(tables.products(spark, sf), "PROMO")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,PROMO)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string,p_retailprice:double>" in plan


def test_care_results_make_only_what_they_need(spark, sf):
    plan = QUERIES["sql_crosstab"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "prior_admission_count" not in plan and "comorbidity" not in plan and "physician" not in plan


@pytest.mark.parametrize(
    "key, column, down",
    [("sort_multi", "pos", False), ("gold_department", "performance_score", True), ("sql_department", "performance_score", True),
     ("gold_by_diagnosis", "readmission_rate", True), ("sql_los_trend", "admission_month", False), ("com_rev_category", "total_revenue", True)],
)
def test_lists_come_sorted(spark, sf, key, column, down):
    got = [r[column] for r in QUERIES[key](spark, sf).collect()]
    assert got == sorted(got, reverse=down)


def test_conditional_copy(spark, tmp_path):
    names = schemas.SALES_FILE_COLUMNS
    line = ['1', "O1", "1/2/2020", "1/3/2020", "Std", "C1", 'Ann "A", Lee\nJr "x"', "S", "US", "X", "Y", "1", "R", "P1",
            "Cat", "Sub", "Pen, red", "12.5", "2", "0.1", "3.5"]
    bad = [*line]
    bad[0], bad[17] = "2", "n/a"
    source, out = scratch_dir(spark, "src"), scratch_dir(spark, "out")
    sinks.write_csv(spark.createDataFrame([tuple(line), tuple(bad)], ", ".join(f"`{c}` string" for c in names)), source)
    done = copying.conditional_copy(spark, source, out, schemas.SALES_FILE, "sales", "20240101_000000")
    assert done.rows_copied == 2 and done.target.endswith("/sales_processed_20240101_000000.csv")
    assert done.rows_malformed == 1
    back = files.read_csv_typed(spark, done.target, schemas.SALES_FILE)
    typed = (1, *line[1:17], 12.5, 2, 0.1, 3.5)
    assert rows(back) == [typed, (2, *line[1:17], None, 2, 0.1, 3.5)]
    with pytest.raises(copying.SourceMissing) as e:
        copying.conditional_copy(spark, f"{source}-none", out, schemas.SALES_FILE, "sales", "x")
    assert e.value.code == "FILE_NOT_FOUND"


@pytest.fixture
def sold(spark, tmp_path):
    """A folder with the tables of a sales file: 60 lines, some names with line breaks and quotes."""
    day = "timestamp '2001-02-03'"
    tables = {
        "customer": (5, "id AS c_custkey, concat('Ann \"', id, '\"') AS c_name, 1 AS c_nationkey, 'BUILDING' AS c_mktsegment, 1.5D AS c_acctbal"),
        "part": (14, "id AS p_partkey, concat('pen ', id) AS p_name, 'T' AS p_type, 'B' AS p_brand, 9.5D AS p_retailprice, 3 AS p_size"),
        "orders": (20, f"id AS o_orderkey, id % 6 AS o_custkey, {day} AS o_orderdate, 'F' AS o_orderstatus, 7.5D AS o_totalprice, '1-URGENT' AS o_orderpriority"),
        "lineitem": (60, f"id % 20 AS l_orderkey, id % 15 AS l_partkey, id AS l_suppkey, cast(id % 4 AS int) AS l_linenumber, "
                         f"cast(id AS double) AS l_quantity, if(id = 9, null, id * 1.25D) AS l_extendedprice, 0.05D AS l_discount, {day} AS l_shipdate, 'R' AS l_returnflag"),
    }
    for name, (n, columns) in tables.items():
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_sales_file_deals_lines_twice(spark, sold):
    """Once to the products and once to the orders, which have their customers by then, even if no side is broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_file(spark, sold)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    dealt = 0
    for i, line in enumerate(plan):
        below = next((j for j in range(i + 1, len(plan)) if depth[j] <= depth[i]), len(plan))
        dealt += "Exchange hashpartitioning" in line and any("FileScan" in x and "l_orderkey" in x for x in plan[i:below])
    assert dealt == 2


def test_the_copied_file_is_compressed_and_the_copy_is_plain(spark, sold):
    mark = len(_CREATED.get(spark.sparkContext.applicationId, []))
    copied = QUERIES["pipe_conditional_copy"](spark, sold)
    made = _CREATED[spark.sparkContext.applicationId][mark:]
    names = [n for p in made if "sales-file" in p or "processed" in p for _, _, found in os.walk(p) for n in found if n.startswith("part-")]
    assert {n.split(".", 1)[1] for n in names} == {"csv", "csv.gz"}
    want = sales_file(spark, sold)
    typed = [F.col(f"`{c}`").try_cast(schemas.SALES_FILE_TYPES.get(c, "string")).alias(c) for c in schemas.SALES_FILE_COLUMNS]
    assert rows(copied.drop("rows_copied", "rows_malformed")) == rows(want.select(*typed))
    assert {(r.rows_copied, r.rows_malformed) for r in copied.collect()} == {(want.count(), want.where("Sales IS NOT NULL AND try_cast(Sales AS double) IS NULL").count())}


@pytest.mark.parametrize("key", ["dq_report", "sink_json_report"])
def test_reported_files_are_compressed(spark, sold, key):
    mark = len(_CREATED.get(spark.sparkContext.applicationId, []))
    report = QUERIES[key](spark, sold)
    made = [p for p in _CREATED[spark.sparkContext.applicationId][mark:] if "sales-file" in p]
    names = [n for p in made for _, _, found in os.walk(p) for n in found if n.startswith("part-")]
    assert len(made) == 1 and names and all(n.endswith(".csv.gz") for n in names)
    file = sales_file(spark, sold)
    blank = sum(file.where(F.trim(F.coalesce(f"`{c}`", F.lit(""))) == "").count() for c in schemas.SALES_FILE_COLUMNS)
    got = {r["check_name"]: (r["passed"], r["observed"]) for r in report.collect()}
    assert got["row_count"] == (False, file.count()) and got["null_values"] == (False, blank) and got["column_headers"] == (True, 21)


@pytest.mark.parametrize("cell", ["", "cr\rx", "a\r\nb", 'Ann "A", Lee', 'two\nlines, "q"', '"', '""', ",", " pad ", None, "back\\slash\\", "ü—東"])
def test_cells_survive_a_file(spark, cell):
    path = scratch_dir(spark, "cells")
    sinks.write_csv(spark.createDataFrame([(1, cell, "next"), (2, "x", "y")], "id int, t string, u string"), path)
    want = [(1, cell, "next"), (2, "x", "y")]
    assert rows(files.read_csv_typed(spark, path, "id int, t string, u string")) == want
    assert [r[1:] for r in rows(files.read_csv_strings(spark, path))] == [w[1:] for w in want]
    assert rows(files.read_csv_inferred(spark, path), "t", "u") == sorted((w[1:] for w in want), key=str)


def test_multiline_text_and_md5(spark):
    import hashlib

    path = scratch_dir(spark, "text")
    text = 'two\nlines, "quoted" and  blanks '
    sinks.write_csv(spark.createDataFrame([(1, text)], "id int, t string").coalesce(1), path)
    assert files.read_csv_typed(spark, path, "id int, t string").first()["t"] == text
    facts = files.file_md5(spark, path, "*.csv").where("size_bytes > 10").first()
    local = [f for f in __import__("glob").glob(f"{path}/*.csv") if f.endswith(facts["item_name"])][0]
    assert facts["md5"] == hashlib.md5(open(local, "rb").read()).hexdigest()
    meta = files.file_metadata(spark, path, "*.csv").where("size_bytes > 10").first()
    assert (meta["item_name"], meta["extension"]) == (facts["item_name"], "csv")


def test_report_names_and_limits(spark, sf):
    s = tables.star(spark, sf)
    with pytest.raises(ValueError, match="unknown report"):
        reports.run_report("nope", s)
    for limit in (0, 1001, True, "5"):
        with pytest.raises(ValueError):
            reports.run_report("revenue", s, reports.Options(limit=limit))
    assert list(reports.run_report("all", s)) == list(reports.REPORTS)


def test_nothing_is_left_behind(spark, sf):
    """Schemas and views go with the query, scratch folders with the clean-up."""
    kept = lambda: (len(spark.catalog.listDatabases()), len(spark.catalog.listTables()))
    before, mark = kept(), scratch_count(spark)
    for name in ("src_table", "src_namespace", "sink_table_overwrite", "src_view_sql"):
        assert QUERIES[name](spark, sf).count() > 0
    assert kept() == before
    made = scratch_count(spark) - mark
    assert made > 0 and 0 < clean_up(spark, mark) <= made and scratch_count(spark) == mark


def test_shares_add_up(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 5)], "k string, v long")
    assert abs(R.share_of_total(df, "v", "p", 6).agg(F.sum("p")).first()[0] - 100) < 1e-4


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(R.reconcile(a, b, "k")) == [(1, "left_only"), (2, "matched"), (3, "right_only")]


def test_histogram_holds_every_value(spark):
    far = [(-1e9,), (0.0,), (9.9,), (10.0,), (100.0,), (101.0,), (1e9,), (None,)]
    got = rows(R.histogram(spark.createDataFrame(far, "v double"), "v", 10), "bin", "rows_in_bin")
    assert got == [(0, 1), (5, 5), (9, 1)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(R.histogram(same, "v", 4)) == [(0, 3.0, 3.0, 2)]


def test_top_k_has_no_limit_of_its_own(spark):
    assert R.top_k(spark.range(3000), 2000, F.desc("id")).count() == 2000


def test_distinct_counts_do_not_multiply_rows(spark, sf):
    s = tables.star(spark, sf)
    plans = [commerce.revenue_by_category(s), superstore.overview(superstore.flat_sales(s)), agg_count_distinct(spark, sf)]
    assert all("Expand" not in df._jdf.queryExecution().executedPlan().toString() for df in plans)


def test_a_cluster_needs_the_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Fake:
        conf = Conf()
        sparkContext = None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Fake(), "x")


def files_below(root):
    """file -> (bytes, change time) of all data files."""
    import os

    found = {}
    for folder, _, names in os.walk(root):
        if "/_log" not in folder:
            for n in names:
                if n.endswith(".parquet"):
                    facts = os.stat(f"{folder}/{n}")
                    found[f"{folder}/{n}".removeprefix(root)] = (facts.st_size, facts.st_mtime_ns)
    return found


LINES = "id long, line int, name string"


def lines_of(spark, ids, name):
    return spark.createDataFrame([(i, i % 3, name) for i in ids], LINES)


def test_a_merge_leaves_untouched_ranges_alone(spark):
    root = scratch_dir(spark, "ranges")
    first = lines_of(spark, range(1000), "old")
    by = snapshots.key_ranges(first, "id", rows=100, least=4)
    assert by == "`id` div 100"
    snapshots.publish(first, root, "WRITE", by)
    before, parts = files_below(root), snapshots.parts(spark, root)
    assert len(parts) == 10 and sum(p.row_count for p in parts) == 1000
    assert snapshots.merge(lines_of(spark, [5, 250, 251, 1700, -20], "new"), root, ["id", "line"], "MERGE") == 1
    after = files_below(root)
    assert all(after[f] == facts for f, facts in before.items())  # nothing that was there is changed
    kept = {p.folder for p in parts} & {p.folder for p in snapshots.parts(spark, root)}
    assert len(kept) == 8  # ranges 0 and 2 are new, so are 17 and that of the negative key, which is 0
    added = {f.split("/_part=")[1].split("/")[0] for f in after if f not in before}
    assert added == {"0", "2", "17"}
    want = [(i, i % 3, "new" if i in (5, 250, 251) else "old") for i in range(1000)] + [(1700, 2, "new"), (-20, 1, "new")]
    assert rows(snapshots.read(spark, root)) == sorted(want, key=str)
    assert rows(snapshots.read(spark, root, 0)) == rows(first)
    assert [(r.version, r.operation, r.row_count) for r in snapshots.history(spark, root).collect()] == [(1, "MERGE", 1002), (0, "WRITE", 1000)]


def test_a_merge_reads_only_the_ranges_it_touches(spark):
    root = scratch_dir(spark, "ranges")
    snapshots.publish(lines_of(spark, range(100), "old"), root, "WRITE", "id div 10")
    seen = {}

    def combine(stored, source):
        seen["rows"] = stored.count()
        return M.upsert(stored, source, ["id", "line"])

    snapshots.merge(lines_of(spark, [33, 34, 500], "new"), root, ["id", "line"], "MERGE", combine=combine)
    assert seen["rows"] == 10 and snapshots.read(spark, root).count() == 101
    assert snapshots.merge(lines_of(spark, [], "new"), root, ["id", "line"], "MERGE") == 2
    assert snapshots.read(spark, root).where("name = 'new'").count() == 3
    with pytest.raises(FileNotFoundError):
        snapshots.parts(spark, root, 9)


def test_null_keys_and_empty_tables_have_a_range(spark):
    root = scratch_dir(spark, "ranges")
    snapshots.publish(lines_of(spark, [], "old"), root, "WRITE", "id div 10")
    assert snapshots.read(spark, root).columns == ["id", "line", "name"] and snapshots.read(spark, root).count() == 0
    snapshots.merge(spark.createDataFrame([(None, 1, "a"), (3, 1, "b")], LINES), root, ["id", "line"], "MERGE")
    assert rows(snapshots.read(spark, root)) == [(3, 1, "b"), (None, 1, "a")]
    plain = scratch_dir(spark, "plain")
    snapshots.publish(lines_of(spark, [1], "old"), plain, "WRITE")
    with pytest.raises(ValueError, match="not stored by key ranges"):
        snapshots.merge(lines_of(spark, [1], "new"), plain, ["id"], "MERGE")


def test_what_an_append_writes_grows_with_the_batch(spark):
    root = scratch_dir(spark, "shop")
    stock = spark.range(50)
    snapshots.publish_all({"orders": spark.range(200_000), "items": spark.range(300_000), "stock": stock}, root, "WRITE")
    sizes = []
    for n in (10, 10_000):
        before = files_below(root)
        snapshots.append_all(spark, root, f"BATCH {n}", {"orders": spark.range(n), "items": spark.range(2 * n)}, {"stock": stock})
        after = files_below(root)
        assert all(after[f] == facts for f, facts in before.items())
        sizes.append(sum(size for f, (size, _) in after.items() if f not in before))
    whole = sum(size for size, _ in files_below(f"{root}/v=0").values())
    assert sizes[0] < sizes[1] < whole / 5
    assert [snapshots.read_table(spark, root, t).count() for t in ("orders", "items", "stock")] == [210_010, 320_020, 50]
    assert snapshots.history(spark, root).first()["row_count"] == 210_010 + 320_020 + 50
    assert snapshots.read_table(spark, root, "orders", 1).count() == 200_010


def test_a_stream_rewrites_only_its_ranges(spark):
    root = scratch_dir(spark, "table")
    schema = "id long, name string, stamp string"
    merge = lambda n, *rows_: merge_batch(spark.createDataFrame(rows_, schema), n, root, ["id"], "stamp", [], "id div 10")
    merge(0, *[(i, "x", "2024-02-01") for i in range(50)])
    first = {p.folder for p in snapshots.parts(spark, root)}
    merge(1, (7, "late", "2024-01-01"), (8, "new", "2024-03-01"), (60, "first", "2023-01-01"))
    merge(1, (9, "again", "2025-01-01"))
    assert len(first & {p.folder for p in snapshots.parts(spark, root)}) == 4
    changed = snapshots.read(spark, root).where("name <> 'x'")
    assert rows(changed, "id", "name") == [(60, "first"), (8, "new")]


def test_a_batch_joins_the_lines_once_and_probes_by_order(spark, sf, monkeypatch):
    """The lines are told apart by one join, and only stored keys whose order the batch has are compared in full."""
    from millrace.catalog import changes
    from millrace.operators import merge

    staged, kept = changes.staged, {}

    def keep(df, label):
        kept[label] = staged(df, label)
        return kept[label]

    monkeypatch.setattr(changes, "staged", keep)
    monkeypatch.setattr(merge, "staged", keep)
    done = changes._apply_batch(spark, sf, stored_again=False)
    lines = kept["lines"]
    assert lines.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert not {"revenue", "gross_cents", "revenue_units"} & set(lines.columns)
    assert 0 < lines.where("in_batch").count() < lines.count()
    assert kept["met"].count() == 0 and done.where("kind = 'item'").count() > 0
