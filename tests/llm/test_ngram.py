"""The language model against a plain Kneser-Ney in Python."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ngram
from tests.llm.odd import documents, lowered, plain

END = "</s>"


def brute(train, texts):
    lines = [[*lowered(t), END] for t in train]
    word = Counter(w for line in lines for w in line)
    pair = Counter(p for line in lines for p in zip([None, *line], line))
    total = Counter()
    for (a, _), n in pair.items():
        total[a] += n
    after = Counter(b for _, b in pair)
    types, tokens = len(word), sum(word.values())

    def discounts(counts):
        n = Counter(counts)
        return ngram.discounts(n[1], n[2], n[3], n[4])

    dp, dw = discounts(pair.values()), discounts(after.values())
    spare_w = sum(dw[min(n, 3) - 1] for n in after.values())
    spare_p = Counter()
    for (a, _), n in pair.items():
        spare_p[a] += dp[min(n, 3) - 1]

    def p_word(w):
        if not pair:
            return 1 / (types + 1)
        n = after[w]
        return ((n - dw[min(n, 3) - 1]) if n else 0) / len(pair) + spare_w / len(pair) / (types + 1)

    def p_pair(a, b):
        if not total[a]:
            return p_word(b)
        n = pair[a, b]
        return ((n - dp[min(n, 3) - 1]) if n else 0) / total[a] + spare_p[a] / total[a] * p_word(b)

    out = []
    for t in texts:
        line = [*lowered(t), END]
        score = sum(math.log10(p_pair(a, b)) for a, b in zip([None, *line], line))
        base = sum(math.log10((word[w] + 1) / (tokens + types + 1)) for w in line)
        out.append((len(line), sum(word[w] > 0 for w in line), base, score))
    return out, p_pair, word


@pytest.mark.parametrize("part", [1 << 21, 64])
def test_scores(spark, sf, part, monkeypatch):
    rows = plain(spark, sf)
    learnt = [r for i, r in enumerate(rows) if i % 3]
    model = ngram.train(documents(spark, learnt))
    got = ngram.scores(documents(spark, rows, 2), model).collect()
    want, _, word = brute([r[1] for r in learnt], [r[1] for r in rows])
    assert model.tokens == sum(word.values()) and model.types == len(word)
    got = sorted((str(r["id"]), r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    want = sorted((str(r[0]), *w) for r, w in zip(rows, want))
    for g, w in zip(got, want):
        assert g[:3] == w[:3]
        assert g[3:] == pytest.approx(w[3:], rel=1e-9)
    assert len(got) == len(rows)


def brute_of_order(order, train, texts):
    """Scores by the definition: grams as tuples that begin at most with the start of a text."""
    def grams(line, k):
        line = [None, *line]
        return [tuple(line[i - k + 1 : i + 1]) for i in range(max(1, k - 1), len(line))]

    lines = [[*lowered(t), END] for t in train]
    adjusted = {k: Counter(g for line in lines for g in grams(line, k)) for k in range(1, order + 1)}
    for k in range(1, order):
        before = Counter(g[1:] for g in adjusted[k + 1])
        adjusted[k] = Counter({g: n if k > 1 and g[0] is None else before[g] for g, n in adjusted[k].items()})
    cuts = {}
    for k, c in adjusted.items():
        n = Counter(c.values())
        cuts[k] = ngram.discounts(n[1], n[2], n[3], n[4])
    total, spare = Counter(), Counter()
    for k, c in adjusted.items():
        for g, n in c.items():
            total[g[:-1]] += n
            spare[g[:-1]] += cuts[k][min(n, 3) - 1]

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 1 / (len(adjusted[1]) + 1)
        n = adjusted[len(g)][g]
        return (n - (cuts[len(g)][min(n, 3) - 1] if n else 0) + spare[g[:-1]] * lower) / total[g[:-1]] if total[g[:-1]] else lower

    def score(t):
        line = [None, *lowered(t), END]
        return sum(math.log10(p(tuple(line[max(0, i - order + 1) : i + 1]))) for i in range(1, len(line)))

    return [score(t) for t in texts], p, adjusted[1]


@pytest.mark.parametrize("order, part", [(2, 1 << 21), (3, 1 << 21), (3, 64), (4, 1 << 21)])
def test_scores_of_any_order(spark, sf, order, part, monkeypatch):
    monkeypatch.setattr(ngram, "PART", part)
    rows = plain(spark, sf, 60) if part == 64 else plain(spark, sf)
    learnt = [r for i, r in enumerate(rows) if i % 3]
    model = ngram.train(documents(spark, learnt), order=order)
    got = sorted((str(r["id"]), r["n_tokens"], r["score"]) for r in ngram.scores(documents(spark, rows, 2), model).collect())
    want = sorted((str(r[0]), len(lowered(r[1])) + 1, x) for r, x in zip(rows, brute_of_order(order, [r[1] for r in learnt], [r[1] for r in rows])[0]))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-9)


def test_two_words_of_context_tell(spark):
    """After "b" alone, "c" and "d" are alike; after "a b" and "x b" they are not."""
    model = ngram.train(documents(spark, [(i, t, "en", "s") for i, t in enumerate(["a b c", "x b d"] * 20)]), order=3)
    got = {r["id"]: r["score"] for r in ngram.scores(documents(spark, [(1, "a b c", "en", "s"), (2, "a b d", "en", "s")]), model).collect()}
    assert got[1] > got[2] + 0.5


def test_probabilities_of_triples_sum_to_one():
    _, p, word = brute_of_order(3, ["a b a b c", "a b d", "d d d e", "b a", "c"] * 3, [])
    for context in ((None,), (None, "a"), ("a", "b"), ("d", "d"), ("b", "never seen"), ("never", "seen")):
        assert sum(p((*context, w)) for w in [*(g[0] for g in word), "new"]) == pytest.approx(1)


def test_probabilities_sum_to_one(spark):
    texts = ["a b a b c", "a b d", "d d d e", "b a", "c"] * 3
    _, p, word = brute(texts, [])
    for context in (None, "a", "b", "d", "never seen"):
        assert sum(p(context, w) for w in [*word, "new"]) == pytest.approx(1)


def test_buckets_do_not_change_scores(spark, sf, monkeypatch):
    rows = plain(spark, sf, 60)
    model = ngram.train(documents(spark, rows))
    whole = sorted(map(str, ngram.scores(documents(spark, rows), model).collect()))
    real = ngram.math.log2
    monkeypatch.setattr(ngram.math, "log2", lambda x: max(real(x), 0) + 12)
    cut = ngram.train(documents(spark, rows))
    assert cut.pair_bits > model.pair_bits
    assert sorted(map(str, ngram.scores(documents(spark, rows), cut).collect())) == whole


def test_no_texts(spark):
    model = ngram.train(documents(spark, []))
    assert ngram.scores(documents(spark, []), model).count() == 0
    r = ngram.scores(documents(spark, [(1, "a b", "en", "s")]), model).first()
    assert (r["n_tokens"], r["n_known"], r["base_score"], r["score"]) == (3, 0, 0.0, 0.0)


def test_mix_is_a_bijection():
    import numpy as np

    x = np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64)
    assert (ngram.unmix(ngram.mix(x)) == x).all()


def test_a_bucket_is_added_up_in_little_memory(tmp_path):
    rng = np.random.default_rng(3)
    runs = [np.unique(rng.integers(0, 1 << 22, 150_000, dtype=np.uint64) << ngram.U64(40)) for _ in range(12)]
    runs += [np.array([5, 6, 1 << 62], np.uint64)]
    counts = [rng.integers(1, 90, len(g)) for g in runs[:-1]] + [np.array([7, 1000, 255])]
    table = pa.Table.from_batches([b for g, c in zip(runs, counts) for b in ngram._hand_on(g, c, 0, 64)])
    tracemalloc.start()
    row = ngram._bucket_writer("grams", tmp_path.as_uri())(table).to_pylist()[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * sum(map(len, runs))
    want = Counter()
    for g, c in zip(runs, counts):
        want.update(dict(zip(g.tolist(), c.tolist())))
    found = ngram.Sorted([(0, row["files"])], 0, 64)
    grams = np.array(sorted(want), np.uint64)
    assert (row["types"], row["tokens"]) == (len(want), sum(want.values()))
    assert np.array_equal(found.at(np.arange(len(grams))), grams)
    assert found.find(grams)[1].tolist() == [want[g] for g in grams.tolist()]


class Texts:
    """Stands for a table: gives back the function that its tasks would run."""

    @staticmethod
    def mapInArrow(run, _):
        return run


def test_a_task_counts_in_little_memory():
    """Distinct words throughout: what is held, its sum and what leaves the task must not lie there several times over."""
    made = np.char.mod("%07x ", np.random.default_rng(4).permutation(1 << 20)).reshape(-1, 256)
    batch = pa.record_batch([pa.array(["".join(line).encode() for line in made], pa.binary())], names=["text"])
    run = ngram.counted(Texts, lambda tokens, n: tokens, 2, 64, ngram.HELD)
    found, largest, sent = [], 0, 0
    ngram.split(batch["text"][:1])  # its table stays
    tracemalloc.start()
    for b in run([batch.slice(at, 512) for at in range(0, len(batch), 512)]):
        found += [tuple(r.values()) for r in b.to_pylist()]
        largest, sent = max(largest, *(len(r[1]) for r in found)), max(sent, b.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert largest < 1 << 19 and sent < 1 << 21
    assert peak < 44 << 20
    words, counts = zip(*(ngram._unpacked(blob) for _, blob in found))
    assert len(np.unique(np.concatenate(words))) == (1 << 20) + 1
    assert sum(int(c.astype(np.int64).sum()) for c in counts) == (1 << 20) + len(batch)
    assert all((w >> ngram.U64(62) == b).all() for w, (b, _) in zip(words, found))


@pytest.mark.parametrize("beside", [[], [np.array([3, 0, 255], np.uint8)], [np.array([1, 1 << 40, 0]), np.array([0, 0, 0])]])
def test_rising_numbers_come_back(beside):
    for rising in (np.array([0, 1, 2], np.uint64), np.array([5, 5 + (1 << 30), (1 << 64) - 1], np.uint64)):
        back = ngram._unpacked(ngram._packed(rising, *beside))
        assert [x.tolist() for x in back] == [x.tolist() for x in (rising, *beside)]


def test_what_buckets_add_moves_in_small_rows(spark, monkeypatch):
    monkeypatch.setattr(ngram, "ROW", 64)
    texts = [" ".join(f"w{(i * j) % 997}" for j in range(60)) for i in range(60)]
    model = ngram.train(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), order=3)
    for k in (2, 3):
        for bucket, _ in model.grams[k]:
            rows = [r for b in ngram._traced(model, k)([pa.record_batch([pa.array([bucket])], names=["bucket"])]) for r in b.to_pylist()]
            assert len(rows) > 1 and all(len(ngram._unpacked(x)[0]) <= 64 for r in rows for x in (r["before"], r["begins"]) if x)
