"""Embedding near-duplicates by a subspace pigeonhole join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import finite_vector, null_id_back, one_per_id
from millrace.llm.components import components, local_roots
from millrace.session import staged

SPREAD = 1e-9  # the budgets are widened by this much, so that rounding loses no pair
KEY = ["dim", "block", "cell", "tile", "next", "other"]


def blocks_of(dim: int, width: int) -> list[slice]:
    return [slice(a, min(a + width, dim)) for a in range(0, dim, width)]


def rotation(dim: int, seed: int = 20240229) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    if dim == 0:
        return np.zeros((0, 0))
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def rotated(raw: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors in the rotated frame.

    Summed in a fixed order, not by a matrix product, so that a row gives the same bits in every task.
    """
    # 2 ** e brings the largest component near 1 first, so that squares neither overflow nor vanish.
    e = np.frexp(np.abs(raw).max(1))[1]
    raw = np.ldexp(raw, -e[:, None])
    square = np.zeros(len(raw))
    for x in raw.T:
        square += x * x
    unit = raw / np.sqrt(square)[:, None]
    out = np.zeros_like(unit)
    for k in range(unit.shape[1]):
        out += unit[:, k, None] * turn[k]
    return out


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    width: int = 8,
    tile_rows: int = 16384,
) -> DataFrame:
    """(id, n_links, component_id, kept): links are pairs with cosine >= threshold, in double precision.

    Unit vectors with cosine >= t lie within squared distance 2 - 2t.  Rotated and cut into blocks of
    `width` coordinates, a linked pair stays in at least one block within that block's share of the
    distance (in proportion to its width).  Each block is a range join of its own: rows fall into cells
    along the block's first coordinate, as wide as the block's radius, and meet rows of their own and the
    next cell; inside a cell rows are sorted by the second coordinate and only those within the radius
    are compared.  Candidates of all blocks are united by counting a pair in the first block that finds
    it, and each is verified by its cosine.

    Equal vectors are joined as one with a weight, so copies are never paired.  Cells with more than
    `tile_rows` rows are cut into tiles by hash and joined tile by tile.  A task gives back one row per
    vector that has links there (its number of links and the root of its local links), never the pairs.

    Defined cases: an id that repeats counts once, with its least vector; a null id is an id like any
    other and the smallest; vectors that are null, zero, without components, or hold null or non-finite
    components link with nothing; vectors of different dimension never link.  threshold must be above
    -1.  Empty input gives no rows.
    """
    all_rows = staged(one_per_id(vectors, id_col, vec_col), "vectors")
    usable = finite_vector(F.col("vec")) & F.exists("vec", lambda x: x != 0)
    rows = all_rows.where(usable)
    reps = staged(rows.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "reps")
    budget = (2 - 2 * threshold) + SPREAD

    def cells(batches):
        for b in batches:
            yield pa.record_batch(
                [b["id"], b["weight"], b["vec"], b["dim"], _cells_of(b, width, budget)],
                names=["id", "weight", "vec", "dim", "cells"],
            )

    kind = dict(reps.dtypes)["vec"]
    placed = reps.withColumn("dim", F.size("vec")).mapInArrow(
        cells, f"id long, weight long, vec {kind}, dim int, cells array<int>"
    )
    placed = placed.select("id", "weight", "vec", "dim", F.posexplode("cells").alias("block", "cell"))

    # Cells are at most 2 / radius wide apart, so this has a fixed number of rows per block.
    counts = staged(placed.groupBy("dim", "block", "cell").count(), "cells")
    tiles = F.ceil(F.col("count") / tile_rows).cast("int")
    own = counts.select("dim", "block", "cell", tiles.alias("own"))
    after = counts.select("dim", "block", (F.col("cell") - 1).alias("cell"), tiles.alias("after"))
    prior = counts.select("dim", "block", (F.col("cell") + 1).alias("cell"), tiles.alias("prior"))
    at = ["dim", "block", "cell"]
    sizes = staged(own.join(after, at, "left").join(prior, at, "left").na.fill(0), "tiles")
    dealt = placed.join(sizes, at).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("own")).cast("int"))
    dealt = dealt.withColumn("meet", F.explode(F.expr(MEETINGS)))
    dealt = dealt.select("dim", "block", "meet.*", "id", "weight", "vec")

    def join(table: pa.Table) -> pa.Table:
        return _join(table, width, budget, threshold)

    found = dealt.groupBy(*KEY).applyInArrow(join, "id long, links long, root long")
    found = staged(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("src"), F.col("root").alias("dst")))

    per_rep = reps.join(links, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    per_rep = per_rep.select(
        "vec",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
    linked = rows.join(per_rep, "vec").select("id", "n_links", "component")
    alone = all_rows.where(~usable | usable.isNull())
    alone = alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(
        null_id_back(F.col("id")).alias("id"),
        "n_links",
        null_id_back(F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


#: Where a row of tile `tile` goes: as first side it meets the tiles of the next cell (the first of
#: those groups also holds the meetings inside its own tile) and the later tiles of its own cell; as
#: second side it visits the earlier tiles of its own cell and all tiles of the cell before.
MEETINGS = """
concat(
  transform(sequence(0, greatest(after, 1) - 1),
    b -> struct(cell as cell, tile as tile, true as next, b as other, true as first)),
  filter(transform(sequence(0, own - 1),
    b -> struct(cell as cell, tile as tile, false as next, b as other, true as first)), m -> m.other > m.tile),
  filter(transform(sequence(0, own - 1),
    b -> struct(cell as cell, b as tile, false as next, tile as other, false as first)), m -> m.tile < m.other),
  filter(transform(sequence(0, greatest(prior, 1) - 1),
    b -> struct(cell - 1 as cell, b as tile, true as next, tile as other, false as first)), m -> prior > 0))
"""


def _raw(vec, n: int) -> np.ndarray:
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    return vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _radius2(dim: int, part: slice, budget: float) -> float:
    return budget * (part.stop - part.start) / dim


def _cells_of(batch: pa.RecordBatch, width: int, budget: float) -> pa.Array:
    """For each row its cell in every block."""
    dims = batch["dim"].to_numpy()
    out: list = [None] * len(dims)
    for dim in np.unique(dims):
        here = np.flatnonzero(dims == dim)
        x = rotated(_raw(batch["vec"].take(pa.array(here)), len(here)), rotation(int(dim)))
        parts = blocks_of(int(dim), width)
        step = np.array([np.sqrt(_radius2(dim, p, budget)) * (1 + 1e-9) for p in parts])
        found = np.floor(x[:, [p.start for p in parts]] / step).astype(np.int32)
        for i, row in zip(here, found):
            out[i] = row
    return pa.array(out, pa.list_(pa.int32()))


def _join(table: pa.Table, width: int, budget: float, threshold: float) -> pa.Table:
    key = {c: table[c][0].as_py() for c in KEY}
    dim, block = key["dim"], key["block"]
    first = table["first"].to_numpy()
    order = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
    n, n1 = len(order), int(first.sum())
    ids, weight = table["id"].to_numpy()[order], table["weight"].to_numpy()[order]
    raw = _raw(table["vec"], n)[order]
    x = rotated(raw, rotation(dim))
    unit = raw / np.abs(raw).max(1)[:, None]
    length = np.sqrt((unit * unit).sum(1))
    parts = blocks_of(dim, width)
    within = [_radius2(dim, p, budget) for p in parts]

    links, near_a, near_b = np.zeros(n, np.int64), [], []
    own_tile = key["next"] and key["other"] == 0
    for a, b in _candidates(x[:, parts[block]], n1, within[block], own_tile):
        for j in range(block + 1):  # the pair counts in the first block that finds it
            close = ((x[a, parts[j]] - x[b, parts[j]]) ** 2).sum(1) <= within[j]
            close = close if j == block else ~close
            a, b = a[close], b[close]
        cosine = np.einsum("ij,ij->i", unit[a], unit[b]) / (length[a] * length[b])
        a, b = a[cosine >= threshold], b[cosine >= threshold]
        links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
        near_a.append(a)
        near_b.append(b)
        if sum(map(len, near_a)) > 1 << 20:
            near_a, near_b = _forest(n, near_a, near_b)
    near_a, near_b = _forest(n, near_a, near_b)
    # Smallest id of each local group, not its smallest position.
    by_id = np.argsort(ids, kind="stable")
    place = np.empty(n, np.int64)
    place[by_id] = np.arange(n)
    root = by_id[local_roots(n, place[near_a[0]], place[near_b[0]])[place]]
    hit = links > 0
    return pa.table({"id": ids[hit], "links": links[hit], "root": ids[root[hit]]})


def _forest(n: int, a: list, b: list) -> tuple[list, list]:
    """The same groups with one link per row."""
    if not a:
        return [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    root = local_roots(n, np.concatenate(a), np.concatenate(b))
    rows = np.flatnonzero(root != np.arange(n))
    return [rows], [root[rows]]


def _candidates(x: np.ndarray, n1: int, within: float, own_tile: bool, rows: int = 512, most: int = 1 << 16):
    """Pairs of positions within the block's squared distance, in pieces of at most `most`.

    Rows are sorted by the second coordinate (the first, if there is only one); each run of rows meets
    only rows within the radius of it.
    """
    along = x[:, min(1, x.shape[1] - 1)]
    reach = np.sqrt(within) * (1 + 1e-9)
    small = x.astype(np.float32)
    square = (small * small).sum(1)
    left = np.argsort(along[:n1], kind="stable")
    sides = [(left, True)] if own_tile else []
    if n1 < len(x):
        sides.append((n1 + np.argsort(along[n1:], kind="stable"), False))
    for right, same in sides:
        line = along[right]
        for at in range(0, n1, rows):
            run = left[at : at + rows]
            low = at if same else np.searchsorted(line, along[run[0]] - reach)
            high = np.searchsorted(line, along[run[-1]] + reach, side="right")
            for to in range(low, high, 8 * rows):
                meet = right[to : min(to + 8 * rows, high)]
                gap = small[run] @ small[meet].T
                gap *= -2
                gap += square[run][:, None]
                gap += square[meet][None]
                i, j = np.nonzero(gap <= within + 1e-5)
                if same:
                    later = (to + j) > (at + i)
                    i, j = i[later], j[later]
                for s in range(0, len(i), most):
                    yield run[i[s : s + most]], meet[j[s : s + most]]
