"""Every stage of the pipeline against plain Python, each on its own input."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import toxicity
from tests.llm.odd import documents, words
from tests.llm.test_mixing import reshared
from tests.llm.test_simhash import brute


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def docs(spark, sf, n=200):
    return spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id") < n)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "mix_sources", "sentencepiece"]


def test_toxic_documents_go(spark, sf):
    table = docs(spark, sf)
    left = stage("toxicity")(spark, table, sf)
    assert left.columns == table.columns
    model = toxicity.train(table, spark.read.parquet(f"{sf}/labels.parquet"))
    want = {r["doc_id"] for r in toxicity.scored(table, model).where("score < 0.5").select("row.doc_id").collect()}
    assert {r["doc_id"] for r in left.collect()} == want


def test_one_document_of_each_group_stays(spark, sf):
    table = docs(spark, sf, 90)
    left = stage("simhash_near_dedup")(spark, table, sf)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    want = {c for _, _, c in brute(rows, 3, 2)}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(want)
    assert left.columns == table.columns


def test_sources_come_out_at_their_targets(spark, sf):
    table = docs(spark, sf)
    left = stage("mix_sources")(spark, table, sf)
    assert left.columns == table.columns
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in table.collect():
        n = len(words(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in left.collect():
        taken[r["source"]] += len(words(r["text"]))
    assert max(Counter(r["doc_id"] for r in left.collect()).values()) <= 3
    for s, t in reshared(sizes, (1, 2, 3), 3).items():
        assert abs(taken[s] - t) <= 3 * largest[s] + 1


def test_ids_are_the_model_s(spark, sf):
    table = docs(spark, sf, 60)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in table.collect()}
    got = stage("sentencepiece")(spark, table, sf).collect()
    assert len(got) == len(text)
    assert all(r["ids"] == library.encode(text[r["doc_id"]]) and r["same_text"] for r in got)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_and_no_documents(spark, sf, name):
    odd = documents(spark)
    out = stage(name)(spark, odd, sf)
    assert out.count() > 0
    if name != "sentencepiece":
        assert out.columns == odd.columns
    if name in ("toxicity", "sentencepiece"):  # none of them is toxic, none is lost
        assert out.count() == odd.count()
    assert stage(name)(spark, documents(spark, []), sf).count() == 0


def test_the_whole_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    by_hand = table
    for _, f in corpus_pipeline.STAGES:
        by_hand = f(spark, by_hand, sf)
    rows = lambda df: sorted((r["doc_id"], r["ids_crc32"]) for r in df.collect())
    assert rows(out) == rows(by_hand) and out.count() > 0
