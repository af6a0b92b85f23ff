"""Exact top-k inner products over norm buckets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import finite_vector, null_id_back, one_per_id
from millrace.session import staged

CELL = ["grp", "dim", "bucket", "slab"]
OUT = "query_id long, vec_id long, score long"
SLACK = 1e-9  # cosine bounds are widened by this, so that rounding never prunes a hit


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v, dim, norm, bucket): components floor(scale * x), one row per id.

    Vectors that are null or hold null or non-finite components are left out.  The bucket is the length
    in steps of 2 ** (1/4), so 64-bit components give a few hundred buckets at most.
    """
    rows = one_per_id(df.where(finite_vector(F.col(vec_col))), id_col, vec_col)
    rows = rows.select("id", F.transform("vec", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.select("id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))
    bucket = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * 4)).otherwise(-1)
    return rows.withColumn("bucket", bucket.cast("int"))


def top_k(
    vectors: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 64,
    query_every: int = 20,
    slab_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by `query_every`; candidates are all rows but the query's
    own.  Candidates are bucketed by length and each bucket is cut by hash of the id into slabs of about
    `slab_rows`; queries are cut into blocks of about `query_rows`.  Every (block, slab) cell is one small
    task group, so no group grows with the data.  The first pass takes one slab of long vectors and gives
    each query a score that its k-th hit reaches at least; the second visits only the buckets whose
    longest vector can reach that score.  Inside a cell the score turns into a local cosine threshold per
    query, which prunes either by one coordinate or by length (`_cell`); what is left is multiplied out.

    Defined cases: an id that repeats counts once, with its least vector; a null id is an id like any
    other, sorts first and is no query; vectors of different dimension have no product; a vector without
    components scores 0 with its like.  Products beyond 64 bits raise.  Empty input gives no rows.
    """
    base = staged(integer_vectors(vectors, id_col, vec_col, scale), "ints")
    is_query = (F.col("id") % query_every == 0) & null_id_back(F.col("id")).isNotNull()
    blocks = -(-base.where(is_query).count() // query_rows) or 1

    buckets = base.groupBy("dim", "bucket").agg(F.count("*").alias("rows"), F.max("norm").alias("longest"))
    buckets = staged(buckets.withColumn("slabs", F.ceil(F.col("rows") / slab_rows).cast("int")), "buckets")
    # The seed is slab 0 of the longest bucket that can fill a result, or else of the longest.
    full = F.col("rows") / F.col("slabs") >= 4 * k
    seed_of = buckets.groupBy("dim").agg(F.max(F.struct(full.alias("full"), "bucket")).alias("s"))
    seeds = seed_of.select("dim", F.col("s.bucket").alias("bucket"))

    queries = base.where(is_query).withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(blocks).cast("long")))
    slab = F.pmod(F.xxhash64("id", F.lit(1)), F.col("slabs")).cast("int")
    groups = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    cands = base.join(buckets.select("dim", "bucket", "slabs"), ["dim", "bucket"]).withColumn("slab", slab)

    q1 = queries.drop("bucket").join(seeds, "dim").withColumn("slab", F.lit(0))
    q1 = q1.withColumn("floor", F.lit(None).cast("long"))
    c1 = cands.where("slab = 0").join(seeds, ["dim", "bucket"], "left_semi")
    first = staged(_cells(q1, c1.withColumn("grp", groups), k), "seeded")

    known = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    known = known.where(F.col("n") >= k).select(F.col("query_id").alias("id"), "floor")
    reach = F.col("floor").isNull() | (F.col("longest") * F.col("norm") * (1 + SLACK) >= F.col("floor"))
    q2 = queries.drop("bucket").join(known, "id", "left").join(buckets, "dim").where(reach)
    q2 = q2.withColumn("slab", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)))
    rest = seeds.withColumn("slab", F.lit(0))
    q2 = q2.join(rest, ["dim", "bucket", "slab"], "left_anti")
    c2 = cands.join(rest, ["dim", "bucket", "slab"], "left_anti").withColumn("grp", groups)
    found = first.unionByName(_cells(q2, c2, k))

    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", null_id_back(F.col("vec_id")).alias("vec_id"), "score")


def _cells(queries: DataFrame, cands: DataFrame, k: int) -> DataFrame:
    left = queries.select(*CELL, "id", "v", F.lit(True).alias("asks"), F.col("floor").cast("double"))
    right = cands.select(*CELL, "id", "v", F.lit(False).alias("asks"), F.lit(None).cast("double").alias("floor"))

    def run(cell: pa.Table) -> pa.Table:
        asks = cell["asks"].to_numpy()
        if asks.all() or not asks.any():
            hits = [np.empty(0, np.int64)] * 3
        else:
            ids, v, floor = cell["id"].to_numpy(), _matrix(cell), cell["floor"].fill_null(-np.inf).to_numpy()
            hits = _cell(ids[asks], v[asks], floor[asks], ids[~asks], v[~asks], k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, hits))))

    return left.unionByName(right).groupBy(*CELL).applyInArrow(run, OUT)


def _matrix(t: pa.Table) -> np.ndarray:
    flat = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(t), -1) if len(flat) else np.zeros((len(t), 1), np.int64)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of every row of a with every row of b: in doubles while those are exact."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound >= 2.0**63:
        raise OverflowError("an inner product does not fit 64 bits")
    if bound >= 2.0**53:
        return a @ b.T
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)


def _cell(qid, q, floor, cid, c, k) -> list[np.ndarray]:
    """Hits of one cell: for each query its k best here that reach its floor, as (query, id, score).

    With t = floor / (|q| * longest), a hit has cosine >= t.  So its unit vector's coordinate f, f being
    the query's largest, lies between cos(a + b) and cos(a - b), where cos a = q_f / |q| and cos b = t.
    Where that interval holds under a fifth of the cell, only those rows are multiplied (coordinate
    pruning); else the cell is scanned from the longest row down, and a query leaves as soon as the
    next rows are too short for its k-th best so far (length pruning).
    """
    qlen = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    clen = np.sqrt((c.astype(np.float64) ** 2).sum(1))
    order = np.lexsort((cid, -clen))
    cid, c, clen = cid[order], c[order], clen[order]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(floor > 0, floor / (qlen * clen[0]), -1.0) - SLACK
    unit = c / np.where(clen > 0, clen, 1.0)[:, None]
    sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out, scan = [], []
    for i in np.flatnonzero(t <= 1):
        if t[i] <= 0:
            scan.append(i)
            continue
        f = int(np.abs(q[i]).argmax())
        if f not in sorted_by:
            by = np.argsort(unit[:, f], kind="stable")
            sorted_by[f] = by, unit[by, f]
        by, line = sorted_by[f]
        a, b = np.arccos(np.clip(q[i, f] / qlen[i], -1, 1)), np.arccos(min(t[i], 1.0))
        low, high = np.cos(min(np.pi, a + b)) - SLACK, np.cos(max(0.0, a - b)) + SLACK
        rows = by[np.searchsorted(line, low) : np.searchsorted(line, high, side="right")]
        if len(rows) * 5 > len(c):
            scan.append(i)
            continue
        s = _scores(q[i : i + 1], c[rows])[0]
        _keep(out, np.full(len(rows), i), rows, s, (s >= floor[i]) & (cid[rows] != qid[i]))
    live, least = np.array(scan, int), floor.astype(np.float64).copy()
    best = np.full((len(q), k), -np.inf)
    for at in range(0, len(c), 1024):
        live = live[qlen[live] * clen[at] * (1 + SLACK) >= least[live]]
        if not len(live):
            break
        s = _scores(q[live], c[at : at + 1024])
        own = qid[live][:, None] == cid[None, at : at + 1024]
        seen = np.concatenate([best[live], np.where(own, -np.inf, s.astype(np.float64))], axis=1)
        best[live] = np.partition(seen, seen.shape[1] - k, axis=1)[:, -k:]
        least[live] = np.maximum(least[live], best[live].min(1))
        i, j = np.nonzero((s >= least[live][:, None]) & ~own)
        _keep(out, live[i], j + at, s[i, j], slice(None))
    if not out:
        return [np.empty(0, np.int64)] * 3
    i, j, s = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((cid[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    start = np.searchsorted(i, i)
    top = np.arange(len(i)) - start < k
    return [qid[i[top]], cid[j[top]], s[top]]


def _keep(out: list, i, j, s, where) -> None:
    out.append((i[where], j[where], s[where]))
