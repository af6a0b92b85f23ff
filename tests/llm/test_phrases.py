"""Phrases against plain counting, and the parts of the stripes against each other."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases
from tests.llm.odd import documents, plain


def pieces(text):
    low = (text or "").encode().lower().decode()
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(rows, words):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            for m in range(1, words + 1):
                f[lang].update(tuple(p[i : i + m]) for i in range(len(p) - m + 1))
    return f, n


def brute(rows, words=4, least=30, share=80, factor=2_000_000, most=2000):
    f, n = counted(rows, words)
    out = set()
    for lang, count in f.items():
        held = {g: c for g, c in count.items() if len(g) > 1 and c >= least}
        longest = Counter()  # by every phrase inside a candidate, the largest count of one that holds it
        for g, c in held.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longest[g[i : i + m]] = max(longest[g[i : i + m]], c)
        scored = []
        for g, a in held.items():
            if 100 * longest[g] >= share * a:
                continue
            cuts = [(factor * a // (count[g[:k]] + count[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), " ".join(g), a, count[g[:k]], count[g[k:]]))
        for rank, (score, _, _, phrase, a, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, phrase, a, left, right, n[lang], -score))
    return out


def result(docs, **options):
    rows = phrases.collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert len(set(map(tuple, rows))) == len(rows)
    return set(map(tuple, rows))


ODD = [
    (3000, "A b c d. a B c d! a b c\td e f\na b, c d a b c d " * 9, None, "a"),
    (3001, "a b c d " * 7, "und", "a"),
    (3002, "x x x x x x x x;y y y " * 4, "", "a"),
    (3003, "ÄB äb \x0b\x0c\x85 ÄB äb " * 5, "de", "a"),
    (3004, ("long" * 200 + " ") * 12 + ("long" * 200 + "x ") * 12, "de", "a"),
]


@pytest.mark.parametrize("options", [{"least": 3}, {"least": 4, "words": 3, "share": 50, "most": 25}, {"least": 12, "factor": 10**17, "words": 2}])
def test_against_plain_counting(spark, sf, options):
    rows = plain(spark, sf, 90) + ODD
    want = brute(rows, **options)
    assert result(documents(spark, rows), **options) == want
    assert len(want) > 40


def tables_for(rows, least):
    grams, table = phrases.write_table(phrases._with_hashes(phrases.word_counts(rows).where(F.col("n") >= least).where("word IS NOT NULL")))
    return table


def test_cut_and_handed_on_stripes_are_the_same(spark, sf):
    """Stripes cut into many parts, handed on early and merged in small steps."""
    rows = documents(spark, plain(spark, sf, 60) + ODD).select("lang", F.col("text").cast("binary").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    tables = [tables_for(rows, 3)]

    def flat(found):
        entries, total = {}, Counter()
        for r in found.collect():
            total[r["prefix"]] += r["total"]
            for w, n in zip(r["next"], r["n"]):
                assert (r["prefix"], w) not in entries
                entries[r["prefix"], w] = n
        return entries, {p: total[p] for p, _ in entries}

    want = flat(phrases.stripes(rows, tables, 3))
    assert want[0] and flat(phrases.stripes(rows, tables, 3, tokens=1 << 34, part_of=5, hold=50, at_once=7)) == want
    counts = tables[0].counts(np.arange(len(tables[0])))
    assert all(counts[p] == n for p, n in want[1].items())  # a stripe's total is the count of its prefix


def test_wide_ids_are_counted_alike():
    draw = np.random.default_rng(4)
    for top in (1 << 20, 1 << 45):
        prefix, nxt, n = draw.integers(0, 40, 500) * (top // 40), draw.integers(0, 30, 500) * (top // 30), draw.integers(1, 9, 500)
        for weights in (None, n):
            want = Counter()
            for p, x, c in zip(prefix.tolist(), nxt.tolist(), (n if weights is not None else np.ones(500, int)).tolist()):
                want[p, x] += c
            got = phrases.distinct(prefix, nxt, weights)
            assert list(zip(*[g.tolist() for g in got])) == [(*k, c) for k, c in sorted(want.items())]


def test_table_finds_grams_that_share_a_hash(tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "key_hash", lambda a, b: (a + b) % 7)
    a, b = np.divmod(np.arange(100), 10)
    order = np.lexsort((b, a, (a + b) % 7))
    a, b = a[order], b[order]
    cut = int(np.searchsorted((a + b) % 7, 3))
    uris = []
    for k, part in enumerate((slice(0, cut), slice(cut, 100))):
        uris.append(str(tmp_path / f"{k}.bin"))
        np.stack([(a + b)[part] % 7, a[part], b[part], a[part] * 100 + b[part]]).astype(np.int64).tofile(uris[-1])
    table = phrases.Table(uris, np.array([0, 3]), np.array([0, cut, 100]))
    draw = random.Random(6)
    ask = [(draw.randrange(14), draw.randrange(14)) for _ in range(400)]
    got = table.find(*(np.array(x, np.int64) for x in zip(*ask)))
    place = {k: i for i, k in enumerate(zip(a.tolist(), b.tolist()))}
    assert got.tolist() == [place.get(k, -1) for k in ask]
    assert table.counts(np.arange(100)).tolist() == (a * 100 + b).tolist()


def test_words_and_hashes_of_odd_texts():
    texts = ["A.b", None, "", " \t ", "é\x85x y" * 3, "z" * 600, "z" * 599 + "y", "same Same"]
    tokens = phrases.split(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    want = [(i, w) for i, t in enumerate(texts) for p in pieces(t) for w in p]
    assert list(zip(tokens.text.tolist(), tokens.words().to_pylist())) == want
    seeds = np.zeros((2, len(texts)), np.uint64)
    for h in tokens.hashes(seeds):
        assert len(set(h.tolist())) == len({w for _, w in want})
    assert len(np.unique(tokens.piece[:2])) == 2


def test_empty(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None, "a"), (2, " . ", "en", "a")])).count() == 0
