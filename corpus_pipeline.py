"""A training-data pipeline over `documents`: a list of stages, each one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import mixing, pieces, simhash, toxicity
from millrace.llm.common import prepared
from millrace.session import staged


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of at least 0.5 go; the model learns from the documents and labels at hand.

    Null and empty texts have the lowest score and stay unless labels say most texts are toxic; repeated rows stay or
    go together; without labels, or without documents, nothing goes.  Other columns pass through.
    """
    prepared(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, held_out=0)
    return toxicity.scored(docs, model).where("score < 0.5").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group stays: 3-word shingles, 2 bits.

    It is the one with the smallest id, a null id last; of rows that repeat an id one stays.  Null and empty texts are
    one group.  No documents give none.
    """
    prepared(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3, repeating, and at most three times their size; copies are rows.

    A null source is a source like any other, the last one.  Texts without words take no share, so how often they
    come changes nothing; ties of size go by id.  No documents give none.
    """
    prepared(spark)
    return mixing.mix(docs, weights=(1, 2, 3), most=3)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, ids_crc32, same_text): piece ids of each text, and whether they decode to it.

    Null and empty texts have no ids and decode to the empty text; repeated rows come as often as they are there.
    """
    prepared(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.round_trip(docs, model)
    same = F.col("decoded") == F.coalesce("row.text", F.lit(""))
    n = F.size("ids").cast("long").alias("n_tokens")
    return found.select("row.doc_id", "row.lang", "row.source", n, "ids", "ids_crc32", same.alias("same_text"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("mix_sources", mixed),
    ("sentencepiece", encoded),
]

# SQL cannot say the stages; tests/llm/test_pipeline.py holds them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
