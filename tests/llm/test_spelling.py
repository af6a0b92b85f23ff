"""Spelling variants against all pairs of words, and the parts of the gram index against what they promise."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import spelling
from tests.llm.odd import documents, plain

SMALL = str.maketrans(spelling.UPPER, spelling.LOWER)


def counted(rows, every=97, shortest=5, least=3):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def near(a, b):
    """One inserted, deleted or replaced code point, by trying every place."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n, factor=2):
    near_to = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and near(w, v)] for w in n}
    form = {}
    for w, others in near_to.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near_to[w]), n[form[w]] if form[w] else None))
    return out


def result(docs, **options):
    rows = spelling.variants(docs, **options).collect()
    got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


ODD_WORDS = [
    (1, "aaaaa aaaaaa aaaaaaa " * 3, "en", "a"),
    (2, "École école ÉCOLE écolè Ecole " * 4, "fr", "a"),
    (3, "worded wordes wordee wordef " * 5 + "xordef " * 40, "en", "b"),
    (4, ("y" * 40_000 + " ") * 3 + ("y" * 40_001 + " ") * 9, "en", "b"),
    (None, "worded worded a×b÷cde " * 3, "en", "b"),
    (6, "chaina " * 3 + "chainb " * 9 + "chainbb " * 30, "en", "b"),
]


def test_against_all_pairs(spark, sf):
    rows = plain(spark, sf, 60) + ODD_WORDS
    want = brute(counted(rows, every=7), 2)
    assert result(documents(spark, rows), every=7) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # some chain has more than one step


@pytest.mark.parametrize("limit", [2, 7])
def test_long_lists_are_cut_and_lose_nothing(spark, sf, monkeypatch, limit):
    rows = plain(spark, sf, 40) + ODD_WORDS
    monkeypatch.setattr(spelling, "LIST", limit)
    assert result(documents(spark, rows), every=11) == brute(counted(rows, every=11))


def test_cut_lists_are_short(spark, monkeypatch):
    """Words that share their first half in one huge list."""
    monkeypatch.setattr(spelling, "LIST", 16)
    draw = random.Random(5)
    words = sorted({"commonhead" + "".join(draw.choices("abcdef", k=8)) for _ in range(3000)})
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, word string")
    lists = spelling.cut_long_lists(spelling.list_entries(frame, spelling.frequent_grams(frame), 5))
    most = lists.groupBy("key").count().agg({"count": "max"}).first()[0]
    assert most <= 2 * 16
    got = {(r["a"], r["b"]) for r in spelling.near_words(frame, 5).collect()}
    at = {w: i for i, w in enumerate(words)}
    want = set()
    for w in words:
        for i in range(len(w)):
            for c in "abcdef":
                v = w[:i] + c + w[i + 1 :]
                if v != w and v in at:
                    want.add((at[w], at[v]))
    assert got == want


def test_grams_outlive_edits():
    """All grams but the affected ones are in the other word, and one shared list is in both words' lists."""
    draw = random.Random(1)
    words = ["".join(draw.choices("abc", k=draw.randint(5, 9))) for _ in range(300)]
    counts = Counter(f"^{w}$"[p : p + q] for w in words for q in range(2, 6) for p in range(len(w) + 3 - q))
    frequent = {g: n for g, n in counts.items() if n > 3}
    assert any(len(g) == spelling.LONGEST for g in frequent)

    def grams(w):
        w = f"^{w}$"
        return Counter(w[p:e] for p, e in spelling.decompose(w, frequent))

    def keys(w, size):
        return {(f, b, w[:f], w[len(w) - b :]) for f, b in spelling.list_places(w, frequent) if f + b <= size}

    for w in words:
        bound = spelling.most_affected(spelling.decompose(f"^{w}$", frequent), len(w) + 2)
        assert sum(grams(w).values()) > bound
        i, c = draw.randrange(len(w) + 1), draw.choice("abcd")
        for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]):
            if near(w, v):
                assert (grams(w) & grams(v)).total() >= grams(w).total() - bound
                assert keys(w, min(len(w), len(v))) & keys(v, min(len(w), len(v)))


def test_one_edit_in_bulk():
    draw = random.Random(2)
    pairs = []
    for _ in range(3000):
        a = "".join(draw.choices("ab", k=6))
        pairs.append((a, "".join(draw.choices("ab", k=draw.choice([6, 7])))))
    code = [np.array([[ord(c) for c in w.ljust(7, "\0")] for w in side], np.uint8) for side in zip(*pairs)]
    got = spelling.one_edit(*code, 6, code[1][:, 6] != 0)
    assert got.tolist() == [near(a, b) for a, b in pairs]


def test_empty(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, None, "en", "a"), (2, "", None, None), (3, "once only here", "en", "a")])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(documents(spark, []), shortest=3)
