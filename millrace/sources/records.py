"""Records of delimited files with line breaks inside quoted cells, read by many tasks.

A line break is inside a cell if an odd number of quotes stands before it in its file (a quote in a cell is
doubled, which adds two).  So three small facts decide how a file is read: the quotes of every split are
counted, a running sum of their parities over a file's splits says which of them start inside a cell, and each
task then cuts its own lines into records.  Only what a split boundary tears apart, at most a beginning and an
end per split, meets elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import staged

QUOTE = '"'
BOM = "﻿"
BROADCAST_SPLITS = 1_000_000  # rows of two longs and a flag; a table of more splits is not sent to every task

WHOLE, HEAD, MIDDLE, TAIL = range(4)  # a record, or the piece of one that a split begins with, is all of, or ends with
_PIECES = "file long, start long, kind int, first boolean, record string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line): all lines in the order of their split; a split is a file's hash and first byte."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )


@dataclass
class Layout:
    """What a scan found: does any cell or line end need the records put together, and where splits start."""

    plain: bool
    splits: DataFrame  # file, start, inside
    count: int


def layout(spark: SparkSession, path: str) -> Layout:
    """One pass over the lines, one row per split out of it."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    found = lines_of(spark, path).select("file", "start", (quotes % 2).alias("odd"), F.contains("line", F.lit("\r")).alias("cr"))
    per_split = staged(found.groupBy("file", "start").agg(F.sum("odd").alias("odd"), F.max("cr").alias("cr")), "splits")
    facts = per_split.agg(F.count("*").alias("n"), F.max("odd").alias("odd"), F.max("cr").alias("cr")).first()
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return Layout(not facts["odd"] and not facts["cr"], per_split.select("file", "start", inside.alias("inside")), facts["n"])


def records(spark: SparkSession, path: str, found: Layout | None = None, broadcast: int = BROADCAST_SPLITS) -> DataFrame:
    """(record, first): every record of the files below `path` as text, whatever cells hold; `first` marks each file's first one.

    Defined cases: blank lines outside cells are no records; a carriage return before a record's end is part
    of the line end, in a cell it stays; a quote that is never closed takes the rest of its file, as a
    record; an empty file has none.
    """
    found = found or layout(spark, path)
    lines = lines_of(spark, path)
    if found.count <= broadcast:  # the lines stay where they are read, in order
        dealt = lines.join(F.broadcast(found.splits), ["file", "start"])
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id()).join(found.splits, ["file", "start"])
        dealt = numbered.repartition("file", "start").sortWithinPartitions("file", "start", "at").drop("at")
    dealt = dealt.select("file", "start", "inside", "line")
    # The files are cut twice rather than written once more: of the torn pieces there are two a split, and only they are staged.
    torn = staged(dealt.mapInArrow(_torn, _PIECES), "torn")
    # Within a file: a tail begins a record, the middles and the head after it belong to it.
    order = Window.partitionBy("file").orderBy("start", "kind")
    group = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    piece = F.struct("start", "kind", "record")
    joined = torn.withColumn("group", group).groupBy("file", "group").agg(F.max("first").alias("first"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n")
    whole = dealt.mapInArrow(_whole, _PIECES).select("record", "first")
    return whole.unionByName(joined.select(F.regexp_replace(text, "\r$", "").alias("record"), "first"))


def _whole(batches):
    return _assemble(batches, whole=True)


def _torn(batches):
    return _assemble(batches, whole=False)


def _assemble(batches, whole: bool):
    """Cut the lines of each split into records, and hand on the whole ones or the pieces; a split may go on in the next batch."""
    split = _Split(None, None, False, whole)
    for b in batches:
        if not len(b):
            continue
        file, start = b["file"].to_numpy(), b["start"].to_numpy()
        cuts = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (start[1:] != start[:-1])])
        for lo, hi in zip(cuts, [*cuts[1:], len(b)]):
            if (file[lo], start[lo]) != (split.file, split.start):
                yield from split.end()
                split = _Split(file[lo], start[lo], b["inside"][lo].as_py(), whole)
            yield from split.feed(b["line"].slice(lo, hi - lo))
    yield from split.end()


class _Split:
    def __init__(self, file, start, inside: bool, whole: bool):
        self.file, self.start, self.inside, self.whole = file, start, inside, whole
        self.open: list[str] = []  # lines of a record that has not ended
        self.torn = inside  # that record began in an earlier split
        self.named = start != 0  # the file's first record has been seen, or is not in this split

    def feed(self, lines: pa.Array):
        odd = pc.count_substring(lines, QUOTE).to_numpy(zero_copy_only=False) & 1
        after = (np.cumsum(odd) + self.inside) & 1
        ends = np.flatnonzero(after == 0)  # lines that end a record
        self.inside = bool(after[-1])
        if not len(ends):
            self.open += lines.to_pylist()
            return
        first = 0
        if self.open or self.torn:
            first = int(ends[0]) + 1
            text = "\n".join([*self.open, *lines.slice(0, first).to_pylist()])
            yield from self._rows([text], HEAD if self.torn else WHOLE)
            self.open, self.torn, ends = [], False, ends[1:]
        if len(ends):
            if self.whole or not self.named:
                cuts = np.r_[first, ends + 1].astype(np.int32) - first
                groups = pa.ListArray.from_arrays(pa.array(cuts), lines.slice(first, int(cuts[-1])))
                yield from self._rows(pc.binary_join(groups, "\n"), WHOLE)
            first = int(ends[-1]) + 1
        self.open = lines.slice(first).to_pylist()

    def end(self):
        if self.open or self.torn:
            yield from self._rows(["\n".join(self.open)], MIDDLE if self.torn else TAIL)

    def _rows(self, texts, kind: int):
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if kind == WHOLE:
            texts = pc.replace_substring_regex(texts, "\r$", "")
        if not self.named and len(texts):
            texts = pa.concat_arrays([pa.array([texts[0].as_py().removeprefix(BOM)], pa.string()), texts[1:]])
        if kind == WHOLE:
            texts = texts.filter(pc.not_equal(pc.utf8_trim_whitespace(texts), ""))
        n = len(texts)
        first = np.zeros(n, bool)
        if n and not self.named:
            first[0] = self.named = True
        if (kind == WHOLE) != self.whole:
            return
        columns = [pa.array([x] * n, t) for x, t in ((self.file, pa.int64()), (self.start, pa.int64()), (kind, pa.int32()))]
        yield pa.record_batch([*columns, pa.array(first), texts], names=[c.split()[0] for c in _PIECES.split(", ")])
