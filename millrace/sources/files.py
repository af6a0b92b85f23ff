"""Readers for delimited and columnar files, and facts about files."""

from __future__ import annotations

import csv
import hashlib
from io import TextIOWrapper

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from millrace.sources import records


# How every delimited file is written and read here: quotes inside a cell are doubled.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}

# A blank cell is NULL and a quoted blank one an empty text: the reader takes this for NULL instead of the blank
# text.  It is made of noncharacters, which no text holds.
NO_VALUE = "\uffff\uffff"
_READ = {**CSV_FORMAT, "nullValue": NO_VALUE, "mode": "PERMISSIVE"}


def _read_csv(
    spark: SparkSession, path: str, schema: str | None, infer: bool, corrupt: str | None, multi_line: bool
) -> DataFrame:
    """Cells by `schema` (DDL text), by inferred types, or as text.

    With `multi_line` a cell may hold line breaks, and still every split of a file is a task of its own:
    where a scan finds no such cell Spark's reader splits the files, else the records are put together first
    (`millrace.sources.records`).  Without it there is no scan, and a line break ends the row wherever it is.
    """
    reader = spark.read.options(**_READ)
    if corrupt:
        schema = f"{schema}, `{corrupt}` string"
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    found = records.layout(spark, path) if multi_line else None
    if found is None or found.plain:
        if found:
            reader = reader.option("lineSep", "\n")
        return (reader.schema(schema) if schema else reader.option("inferSchema", infer)).csv(path)
    cells = records.records(spark, path, found).where(~F.col("first")).select("record")
    options = {**_READ, "multiLine": True} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    if schema is None:
        names = spark.read.options(**CSV_FORMAT, multiLine=True).csv(path).columns  # the first record only
        types = _inferred(cells, options) if infer else []
        kinds = types if len(types) == len(names) else ["string"] * len(names)
        schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in zip(names, kinds))
    text = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return cells.select(F.from_csv("record", schema, text).alias("cells")).select("cells.*")


def _inferred(cells: DataFrame, options: dict) -> list[str]:
    """Types of the cells of records, by the reader's own rules."""
    spark = cells.sparkSession
    lines = getattr(cells._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(**{**options, "header": False, "inferSchema": True})
    return [f.dataType.simpleString() for f in DataFrame(reader._jreader.csv(lines), spark).schema]


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header and inferred types: one more pass over the file, for exploring only."""
    return _read_csv(spark, path, None, True, None, multi_line)


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every column as text, to be coerced later without losing a row."""
    return _read_csv(spark, path, None, False, None, multi_line)


def read_csv_typed(
    spark: SparkSession, path: str, schema: str, corrupt: str | None = None, multi_line: bool = True
) -> DataFrame:
    """An explicit schema (DDL text); with `corrupt`, malformed rows are kept as text in that column.

    A quoted blank cell is malformed where the column is not text.
    """
    return _read_csv(spark, path, schema, False, corrupt, multi_line)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rows_to_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Typed literal rows, for master data and tests."""
    return spark.createDataFrame(rows, schema)


ROW_BYTES = 64 << 20  # a larger file is streamed by its task, not loaded as one row
PIECE_BYTES = 8 << 20
FILES_A_TASK = 64  # whose structure one task reads


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Spark's listing of all files below `path`, which leaves out empty ones."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def _names() -> list[Column]:
    parts = F.split(F.col("path"), "/")
    return [F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("item_name")]


def _opened(uri: str):
    """A stream over a file, from whatever store pyarrow finds the address in."""
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def structure_of(uri: str, delimiter: str = ",") -> tuple[int, str] | None:
    """(columns, structure) of a file: the footer of a Parquet file, else the names in the first record, all text.

    A file without a first record has no structure.
    """
    with _opened(uri) as file:
        if file.size() >= 12 and file.read(4) == b"PAR1":
            schema = from_arrow_schema(pq.read_schema(file), prefer_timestamp_ntz=True)
            return len(schema.fields), schema.simpleString()
        file.seek(0)
        text = TextIOWrapper(file, "utf-8-sig", newline="")
        first = next((r for r in csv.reader(text, delimiter=delimiter) if r), None)
        text.detach()
    if first is None:
        return None
    return len(first), StructType([StructField(c, StringType()) for c in first]).simpleString()


def file_metadata(spark: SparkSession, path: str, glob: str = "*", delimiter: str = ",") -> DataFrame:
    """Name, type, size, change time and structure of every file, a row each.

    Tasks read the files' footers or first records, never the rest; the listing is Spark's own.
    """
    listed = _files(spark, path, glob).select("path", "length", "modificationTime")

    def shapes(batches):
        for b in batches:
            found = [structure_of(p, delimiter) or (None, None) for p in b["path"].to_pylist()]
            b = b.append_column("column_count", pa.array([n for n, _ in found], pa.int32()))
            yield b.append_column("structure", pa.array([t for _, t in found], pa.string()))

    dealt = listed.repartition(max(1, -(-listed.count() // FILES_A_TASK)))
    known = dealt.mapInArrow(shapes, "path string, length long, modificationTime timestamp, column_count int, structure string")
    return known.select(
        F.lit(True).alias("file_exists"),
        *_names(),
        F.lit("File").alias("item_type"),
        F.element_at(F.split(F.element_at(F.split("path", "/"), -1), r"\."), -1).alias("extension"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
        "column_count",
        "structure",
    )


def size_bytes(spark: SparkSession, path: str, glob: str = "*") -> int | None:
    """Bytes of all files below `path`; None if there is nothing."""
    if not path_exists(spark, path):
        return None
    return _files(spark, path, glob).agg(F.sum("length")).first()[0] or 0


def file_md5(spark: SparkSession, path: str, glob: str = "*", row_bytes: int = ROW_BYTES, piece: int = PIECE_BYTES) -> DataFrame:
    """(folder, item_name, size_bytes, md5) of every file, whatever its size.

    A digest is taken in order, so a file is one task's work.  Files up to `row_bytes` are loaded by Spark's
    own reader; a larger one is streamed in pieces of `piece` bytes, so the task holds one piece.
    """
    files = _files(spark, path, glob)
    small = files.where(F.col("length") <= row_bytes).select("path", "length", F.md5("content").alias("md5"))
    large = files.where(F.col("length") > row_bytes).select("path", "length")
    n = large.count()
    if n:

        def digests(batches):
            for b in batches:
                yield b.append_column("md5", pa.array([_streamed_md5(p, piece) for p in b["path"].to_pylist()], pa.string()))

        small = small.unionByName(large.repartition(n).mapInArrow(digests, "path string, length long, md5 string"))
    return small.select(*_names(), F.col("length").alias("size_bytes"), "md5")


def _streamed_md5(uri: str, piece: int) -> str:
    digest = hashlib.md5()
    with _opened(uri) as file:
        while data := file.read(piece):
            digest.update(data)
    return digest.hexdigest()


def text_fingerprint(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(folder, item_name, lines, fingerprint) of text files of any size.

    Files are split and each task sends two numbers per file: the fingerprint is the sum of the lines'
    hashes, so it tells changed, missing and added lines, not their order.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    total = F.sum(F.xxhash64("value").cast("decimal(38,0)"))
    return (
        lines.select("value", F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("lines"), total.cast("string").alias("fingerprint"))
        .select(*_names(), "lines", "fingerprint")
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the path's own file system (object store, HDFS, local)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all below it; False if there was nothing."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))
