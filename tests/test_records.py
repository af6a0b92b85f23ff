"""Delimited files with line breaks in cells, read by many tasks, against Spark's own one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_dir
from millrace.sources import files, records, sinks

SCHEMA = "i int, t string, u string, d double"
PIECES = ['"', '""', ",", "\n", "\n\n", "\r\n", "\r", " ", "a", "ü—東", "\\", "word", '"\n"', ""]


def cells(n, seed):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "", "".join(draw.choices(PIECES, k=draw.randint(1, 12)))])
    return [(draw.choice([None, i]), text(), text(), draw.choice([None, i / 4])) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("200", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("parts, seed", [(1, 1), (3, 2), (1, 3)])
def test_any_cells_come_back_from_many_tasks(spark, small_splits, parts, seed):
    rows = cells(300, seed)
    path = scratch_dir(spark, "cells")
    assert sinks.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(parts), path) == 300
    found = records.layout(spark, path)
    assert not found.plain and found.count > 10 * parts
    want = sorted(map(repr, rows))
    assert bag(files.read_csv_typed(spark, path, SCHEMA)) == want
    one_task = spark.read.options(**files._READ, multiLine=True).schema(SCHEMA).csv(path)
    assert bag(one_task) == want
    text = [tuple(None if x is None else str(x) for x in r) for r in rows]
    assert bag(files.read_csv_strings(spark, path)) == sorted(map(repr, text))
    inferred = files.read_csv_inferred(spark, path)
    assert inferred.schema.simpleString() == "struct<i:int,t:string,u:string,d:double>" and bag(inferred) == want
    torn = records.records(spark, path, found, broadcast=0)  # the way for more splits than are sent to every task
    assert bag(torn) == bag(records.records(spark, path, found))


def test_a_cell_longer_than_splits_is_one_record(spark, small_splits):
    rows = [(1, "x\n" * 2000, "a", 1.0), (2, 'say "\n' * 500, None, 2.0), (3, "", "\n", None)]
    path = scratch_dir(spark, "long")
    sinks.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    assert bag(files.read_csv_typed(spark, path, SCHEMA)) == sorted(map(repr, rows))


def test_plain_files_are_left_to_the_reader(spark, small_splits):
    path = scratch_dir(spark, "plain")
    sinks.write_csv(spark.range(400).selectExpr("id", "concat('a, \"b\" ', id) AS t").coalesce(1), path)
    assert records.layout(spark, path).plain
    back = files.read_csv_typed(spark, path, "id long, t string")
    assert "FileScan csv" in back._jdf.queryExecution().executedPlan().toString()
    assert back.rdd.getNumPartitions() > 10 and back.count() == 400


def write_text(path, name, text):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", newline="", encoding="utf-8") as out:
        out.write(text)


def test_files_of_other_writers(spark, tmp_path, small_splits):
    """A byte order mark, Windows line ends, blank lines, a quote that is never closed, an empty file, no end of line."""
    write_text(tmp_path, "a.csv", '﻿i,t\r\n1,"x\r\ny"\r\n\r\n2,"""z"""\r\n3,""\r\n4,')
    write_text(tmp_path, "b.csv", "")
    write_text(tmp_path, "c.csv", 'i,t\n5,"open\nto the end\n')
    got = files.read_csv_typed(spark, str(tmp_path), "i int, t string").orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, "x\r\ny"), (2, '"z"'), (3, ""), (4, None), (5, "open\nto the end")]


def test_a_single_null_is_a_row(spark):
    path = scratch_dir(spark, "one")
    sinks.write_csv(spark.createDataFrame([("a",), (None,), ("",), ("b\nc",)], "t string").coalesce(1), path)
    assert bag(files.read_csv_typed(spark, path, "t string")) == sorted(["('a',)", "(None,)", "('',)", "('b\\nc',)"])


def test_malformed_records_are_kept(spark, small_splits):
    path = scratch_dir(spark, "bad")
    rows = [("1", "a\nb", "2.5"), ("x", "c\nd", "1"), ("3", "", "n/a"), (None, None, None)]
    sinks.write_csv(spark.createDataFrame(rows, "i string, t string, d string").coalesce(1), path)
    back = files.read_csv_typed(spark, path, "i int, t string, d double", corrupt="bad")
    got = sorted(((r["i"], r["t"], r["d"], r["bad"] is not None) for r in back.collect()), key=str)
    assert got == sorted([(1, "a\nb", 2.5, False), (None, "c\nd", 1.0, True), (3, "", None, True), (None, None, None, False)], key=str)
    assert back.where(F.col("bad").isNotNull()).count() == 2


def test_only_torn_pieces_are_written(spark, small_splits, monkeypatch):
    """Of n splits at most a beginning and an end each go to the store, however many rows the file has."""
    path, written = scratch_dir(spark, "torn"), {}
    sinks.write_csv(spark.createDataFrame(cells(2000, 4), SCHEMA).coalesce(2), path)
    found = records.layout(spark, path)
    monkeypatch.setattr(records, "staged", lambda df, label: written.setdefault(label, df))
    got = records.records(spark, path, found)
    assert not found.plain and got.count() == 2002
    assert [df.where(F.col("kind") == records.WHOLE).count() for df in written.values()] == [0]
    assert all(df.count() <= 2 * found.count for df in written.values())


def test_compressed_files_are_cut_for_many_tasks(spark, small_splits, monkeypatch):
    monkeypatch.setattr(sinks, "PACKED_ROWS", 50)
    rows, path = cells(300, 5), scratch_dir(spark, "packed")
    assert sinks.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, "gzip") == 300
    names = [f.split("/")[-1] for f in spark.read.text(path).inputFiles()]
    assert len(names) == 6 and all(n.endswith(".csv.gz") for n in names)
    back = files.read_csv_typed(spark, path, SCHEMA)
    assert bag(back) == sorted(map(repr, rows)) and back.rdd.getNumPartitions() >= 6
    text = [tuple(None if x is None else str(x) for x in r) for r in rows]
    assert bag(files.read_csv_strings(spark, path)) == sorted(map(repr, text))
