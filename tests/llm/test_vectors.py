"""Vector operators against brute force, on small tables with every odd case."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm import embed, topk

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("id", T.StringType()),  # clashes with the operators' inner names
        T.StructField("vec", T.StringType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", None) for i, v in rows], SCHEMA).repartition(3)


def vectors(n, dim, groups, spread, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, dim))
    x = centre[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, dim))
    x *= rng.uniform(0.2, 5, (n, 1))
    x[::17] = x[0]  # copies
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


ODD = [
    (901, None),
    (902, [0.0] * 12),
    (903, [float("nan")] + [1.0] * 11),
    (904, [None] + [1.0] * 11),
    (905, [float("inf")] + [1.0] * 11),
    (906, [1.0, 2.0]),
    (907, [2.0, 4.0]),
    (908, []),
    (909, [1e-30] * 12),
    (910, [2e30] * 12),
    (None, [1.0] * 12),
    (0, [9.0] * 12),  # an id that repeats
]


def one_per_id(rows):
    out = {}
    for i, v in rows:
        if i not in out or out[i] is None or (v is not None and v < out[i]):
            out[i] = v
    return out


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, threshold):
    vecs = one_per_id(rows)
    ids = sorted(vecs, key=lambda i: (i is not None, i or 0))
    links = {i: set() for i in ids}
    for a in ids:
        for b in ids:
            u, w = vecs[a], vecs[b]
            if a != b and good(u) and good(w) and len(u) == len(w) and any(u) and any(w):
                u, w = np.array(u), np.array(w)
                u, w = u / abs(u).max(), w / abs(w).max()
                if u @ w / math.sqrt(u @ u) / math.sqrt(w @ w) >= threshold:
                    links[a].add(b)
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        first = min(seen, key=lambda i: (i is not None, i or 0))
        out[i] = (len(links[i]), first, first == i)
    return out


@pytest.mark.parametrize("tile", [16384, 7])
@pytest.mark.parametrize("spread, threshold, width", [(0.25, 0.95, 8), (0.4, 0.8, 5), (0.1, 0.95, 1)])
def test_links_equal_brute_force(spark, tile, spread, threshold, width):
    rows = vectors(160, 12, 9, spread, 5) + ODD
    got = embed.near_duplicates(frame(spark, rows), threshold, width=width, tile_rows=tile).collect()
    want = brute_links(rows, threshold)
    assert len(got) == len(want)
    assert {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want


def test_a_dense_group_counts_every_link_once(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(16) + 0.02 * rng.standard_normal(16)).tolist()) for i in range(700)]
    got = embed.near_duplicates(frame(spark, rows), 0.95, tile_rows=200).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(699, 0)}


def brute_top(rows, k, every, scale):
    ints = {i: [math.floor(scale * x) for x in v] for i, v in one_per_id([r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]).items()}
    out = []
    for q in ints:
        if q is None or q % every:
            continue
        hits = [(-sum(a * b for a, b in zip(ints[q], v)), c is not None, c or 0, c) for c, v in ints.items() if c != q and len(v) == len(ints[q])]
        out += [(q, r + 1, h[3], -h[0]) for r, h in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("slab, block", [(8192, 2048), (16, 4)])
@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_top_k_equals_brute_force(spark, slab, block, spread):
    rows = vectors(220, 12, 4, spread, 8) + [r for r in ODD if r[0] != 910]
    got = topk.top_k(frame(spark, rows), 5, scale=64, query_every=4, slab_rows=slab, query_rows=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_top(rows, 5, 4, 64)


def test_products_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**24 + 2 * i), 1.0 + i]) for i in range(12)]
    got = topk.top_k(frame(spark, rows), 3, query_every=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_top(rows, 3, 3, 64)


def test_empty_tables(spark):
    assert embed.near_duplicates(frame(spark, [])).count() == 0
    assert topk.top_k(frame(spark, []), 5).count() == 0
    assert topk.top_k(frame(spark, [(0, [1.0])]), 5).count() == 0
