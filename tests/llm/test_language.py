"""Language profiles against plain counting, and held-out accuracy."""

import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language
from tests.llm.odd import ODD, documents, plain


def grams(text):
    """Counts of the grams of 1 to 3 letters in padded words."""
    low = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    n = Counter()
    for word in low.split(" "):
        if word:
            n.update(word)
            padded = f" {word} "
            for q in (2, 3):
                n.update(padded[i : i + q] for i in range(len(padded) - q + 1))
    return n


def top(n, size):
    return {g: i for i, (g, _) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:size])}


def brute(train, texts, size):
    counts = {}
    for text, lang in train:
        if lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: top(n, size) for lang, n in sorted(counts.items()) if n}
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or "") or not profiles:
            out.append(("und", 0.0))
            continue
        mine = top(grams(text), size)
        away = [(sum(abs(i - p[g]) if g in p else size for g, i in mine.items()), lang) for lang, p in profiles.items()]
        ranked = sorted(away)
        second = ranked[1][0] if len(ranked) > 1 else size * len(mine)
        out.append((ranked[0][1], 1 - ranked[0][0] / second if second else 0.0))
    return out


@pytest.mark.parametrize("size", [300, 12])
def test_against_plain_counting(spark, sf, size):
    rows = plain(spark, sf, 80) + [(2000, "İstanbul ǅungla ﬁ été", "tr", "a"), (2001, "́̂", "tr", "a"), (2002, "123 !?", "xx", "a")]
    docs = documents(spark, rows)
    teach = [r for i, r in enumerate(rows) if i % 3]
    model = language.train(documents(spark, teach), size=size)
    got = sorted((str(r["id"]), r["lang_pred"], r["score"]) for r in language.predicted(docs, model).collect())
    want = brute([(r[1], r[2]) for r in teach], [r[1] for r in rows], size)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want))
    assert "xx" not in model.languages


def test_one_language_and_none(spark):
    docs = documents(spark)
    one = language.train(documents(spark, [(1, "abc abd", "en", "a")]))
    want = brute([("abc abd", "en")], [r[1] for r in ODD], language.PROFILE)
    assert sorted((str(r["id"]), r["lang_pred"], r["score"]) for r in language.predicted(docs, one).collect()) == sorted((str(r[0]), *w) for r, w in zip(ODD, want))
    none = language.train(documents(spark, []))
    assert {(r["lang_pred"], r["score"]) for r in language.predicted(docs, none).collect()} == {("und", 0.0)}
    assert language.predicted(documents(spark, []), one).count() == 0


def test_too_many_languages_raise(spark):
    rows = [(i, "some text", f"l{i}", "a") for i in range(5)]
    with pytest.raises(ValueError):
        language.train(documents(spark, rows), languages=4)


def test_many_different_letters_are_taken_in_halves():
    """Texts with so many code points that group and gram do not fit one word together."""
    draw = random.Random(3)
    letters = [chr(i) for i in range(0x3400, 0x9FFF)] + [chr(i) for i in range(0x20000, 0x2A000)]
    texts = ["".join(draw.choices(letters, k=40_000)) for _ in range(3)]
    group = np.array([0, 1 << 20, 1 << 21])
    parts = list(language.counted(texts, group))
    assert len(parts) > 1
    got = Counter()
    for g, gram, n, _ in parts:
        for x, y, c in zip(g.tolist(), gram.tolist(), n.tolist()):
            points = [y >> 42, (y >> 21) & (1 << 21) - 1, y & (1 << 21) - 1]
            got[x, "".join(chr(p) for p in points if p)] += c
    want = Counter()
    for g, t in zip(group.tolist(), texts):
        want.update({(g, k): n for k, n in grams(t).items()})
    assert got == want


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.train(docs.where(~held))
    found = language.predicted(docs.where(held), model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98
