"""SimHash groups against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from tests.llm.odd import documents, lowered, plain


def brute_fingerprint(text, k):
    w = lowered(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, most):
    """Index -> smallest index reachable over pairs within `most` bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def brute(rows, k, most):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [brute_fingerprint(r[1], k) for r in rows]
    return sorted(
        ((r[0], f"{fp:016x}", rows[g][0]) for r, fp, g in zip(rows, fps, groups(fps, most))), key=str
    )


def near_copies(rows, seed=3):
    r, out = random.Random(seed), []
    for i, t, lang, source in rows:
        if t and 20 < len(t) < 3000 and r.random() < 0.5:
            w = t.split(" ")
            for c in range(r.randint(1, 4)):
                v = list(w)
                v[r.randrange(len(v))] += r.choice(["", "x"])
                out.append((10_000 + 10 * (i or 0) + c, " ".join(v), lang, source))
    return rows + out


@pytest.mark.parametrize("k, most", [(3, 2), (1, 0), (2, 3)])
def test_equals_all_pairs(spark, sf, k, most):
    rows = near_copies(plain(spark, sf, 60))
    got = simhash.near_duplicates(documents(spark, rows), shingle=k, max_bits=most).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, k, most)


def test_one_of_each_group_stays(spark, sf):
    rows = near_copies(plain(spark, sf, 60))
    got = simhash.keep_one(documents(spark, rows), shingle=3, max_bits=2)
    assert got.columns == documents(spark, rows).columns
    want = {c for _, _, c in brute(rows, 3, 2)}
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert sorted(ids, key=str) == sorted(want, key=str)


def test_every_pair_within_two_bits_shares_a_key():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 2**64, 300, dtype=np.uint64)
    keys = [set(k) for k in simhash.fuzzy_keys(fps, 2).tolist()]
    for a in range(64):
        for b in range(a, 64):
            near = fps ^ np.uint64((1 << a) | (1 << b))
            other = simhash.fuzzy_keys(near[:3], 2).tolist()
            assert all(keys[i] & set(other[i]) for i in range(3))


def test_golay_code_is_perfect():
    words = np.arange(1 << simhash.GOLAY_BITS)
    count = np.bincount(simhash.codeword_index(words), minlength=1 << 12)
    assert (count == 2048).all()


@pytest.mark.parametrize("n", [90, 1500, 5000])
def test_large_key_groups(n):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 2**64, 3, dtype=np.uint64)
    fps = np.unique(centre[rng.integers(0, 3, n)] ^ rng.integers(0, 2**14, n, dtype=np.uint64) * np.uint64(5))
    root = simhash._group_roots(fps, 2)
    sample = rng.choice(len(fps), min(len(fps), 80), replace=False)
    for i in sample:
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2)
        assert (root[near] == root[i]).all()
    assert (root <= np.arange(len(fps))).all()


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0
