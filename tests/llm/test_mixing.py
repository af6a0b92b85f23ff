"""Mixing against a plain re-sharing of targets and the rule of crossed boundaries."""

from collections import Counter

import pytest

from millrace.llm import mixing
from tests.llm.odd import documents, plain, words


def reshared(sizes, weights, most):
    """Targets by sharing the excess again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def test_targets_and_taken_words(spark, sf):
    rows = plain(spark, sf)
    got = mixing.copies(documents(spark, rows)).select("id", "size", "source_size", "target", "copies", "doc.source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = reshared(sizes, (1, 2, 3), 3)
    assert len(got) == len(rows)
    assert sorted((str(r["id"]), r["size"], r["source_size"]) for r in got) == sorted((str(r[0]), len(words(r[1])), sizes[r[3]]) for r in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 3 * largest[s] + 1


def test_reruns_and_partitions_do_not_matter(spark, sf):
    rows = plain(spark, sf)
    runs = [
        sorted(map(str, mixing.copies(documents(spark, rows, parts)).select("id", "size", "target", "copies").collect()))
        for parts in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_mixed_rows_are_the_copies(spark, sf):
    rows = plain(spark, sf)
    docs = documents(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.copies(docs).select("id", "size", "copies").collect():
        want[(r["id"], r["size"])] += r["copies"]
    got = Counter((r["doc_id"], len(words(r["text"]))) for r in mixed.collect())
    assert got == +want


def test_a_hot_source_stops_at_three_times_the_others(spark):
    rows = [(i, "w " * 10, "en", "big") for i in range(300)] + [(1000, "w " * 10, "en", "small"), (1001, "", "en", "void")]
    got = {r["source"]: r["target"] for r in mixing.copies(documents(spark, rows)).select("doc.source", "target").collect()}
    assert got == {"big": 2980.0, "small": 30.0, "void": 0.0}


def test_empty(spark):
    assert mixing.copies(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).count() == 0


def test_texts_are_neither_dealt_by_size_nor_sorted(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(mixing, "staged", lambda df, label, real=mixing.staged: kept.setdefault(label, df.columns) and real(df, label))
    rows = [(i, "w " * (i % 50), "en", "ab"[i % 2]) for i in range(400)] + [(7, "w w w", "en", "a"), (None, "w", "en", None)]
    mixed = mixing.mix(documents(spark, rows))
    assert "doc" in kept["rows"] and "doc" not in kept["dealt"]
    plan = mixed._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "ShuffledHashJoin" in joins[0]  # the outermost: of whole rows and their copies
    assert {(r["doc_id"], r["text"]) for r in mixed.collect()} <= {r[:2] for r in rows}
