"""Documents with every odd case, for the tests of the text operators."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use inside
        *(T.StructField(c, T.StringType()) for c in ("id", "row", "fp", "at", "ids", "score", "size", "doc")),
    ]
)

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))

ODD = [
    (900, None, "en", "a"),
    (901, "", "en", "a"),
    (902, " \t\n ", None, None),
    (903, "one", "en", "b"),
    (904, "Two Words", "en", "b"),
    (905, LONG, "en", "b"),
    (906, LONG + " end", "en", "c"),
    (None, "no id here at all", "en", "c"),
    (None, None, None, None),
    (907, "same text twice over again", "en", "a"),
    (907, "same text twice over again", "en", "a"),
    (908, "x" * 50_000, "en", "a"),
    (909, "naïve Ünïcode — 東京 \U0001f600 a b c d", "fr", "d"),
    (910, "\x00 null byte \x1c and \x85", "fr", "d"),
]


def documents(spark, rows=ODD, parts=3):
    full = [(i, t, g, s, len(t) if t else None, *["z"] * 8) for i, t, g, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def plain(spark, sf, n=150):
    """The first documents of the test data, with the odd ones behind."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(n).collect()
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows] + ODD


def words(text):
    """Words as the operators define them: split at ASCII white space."""
    return [w.decode() for w in (text or "").encode().split()]


def lowered(text):
    return [w.decode() for w in (text or "").encode().lower().split()]
