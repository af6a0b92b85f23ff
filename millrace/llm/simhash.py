"""SimHash near-duplicates by Golay-code fuzzy hashing."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components, local_roots
from millrace.session import staged

# Fixed values of the binary Golay code (23, 12): word length, check bits, generator polynomial.
GOLAY_BITS, GOLAY_CHECK, GOLAY_POLY = 23, 11, 0b110001110101

#: The 64 bits as three segments of at most 23: (lowest bit, bits).
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of every single bit, error pattern of every syndrome)."""
    single = np.zeros(GOLAY_BITS, np.int64)
    for bit in range(GOLAY_BITS):
        w = 1 << bit
        while w.bit_length() > GOLAY_CHECK:
            w ^= GOLAY_POLY << (w.bit_length() - GOLAY_CHECK - 1)
        single[bit] = w
    leader = np.zeros(1 << GOLAY_CHECK, np.int64)
    for weight in range(4):
        for bits in combinations(range(GOLAY_BITS), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= int(single[b])
            leader[syndrome] = sum(1 << b for b in bits)
    return single, leader


_SINGLE, _LEADER = _golay_tables()
_HALF = 12  # syndromes are linear: one lookup for the low bits, one for the rest


def _syndromes(bits: int, first: int) -> np.ndarray:
    out = np.zeros(1 << bits, np.int64)
    for b in range(bits):
        out[1 << b : 2 << b] = out[: 1 << b] ^ _SINGLE[first + b]
    return out


_LOW, _HIGH = _syndromes(_HALF, 0), _syndromes(GOLAY_BITS - _HALF, _HALF)


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the one codeword within three bits of each 23-bit word."""
    syndrome = _LOW[words & ((1 << _HALF) - 1)] ^ _HIGH[words >> _HALF]
    return (words ^ _LEADER[syndrome]) >> GOLAY_CHECK


def fuzzy_keys(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint (uint64) the keys of all words within max_bits / 2 bits: one row of keys each, with repeats.

    Of two fingerprints that differ in at most max_bits bits, a word half way lies within
    ceil(max_bits / 2) of either; so its key, the three codeword indices side by side, is among the keys
    of both.  By the pigeonhole over segments those few errors fall on few segments, and as a decoder
    undoes up to three errors, most flips give the key the fingerprint already has.
    """
    radius = -(-max_bits // 2)
    segments = [((fps >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    per_segment = []
    for word, (_, n) in zip(segments, SEGMENTS):
        flips = [[codeword_index(word ^ sum(1 << b for b in c)) for c in combinations(range(n), e)] for e in range(radius + 1)]
        per_segment.append(flips)
    out = []
    for errors in np.ndindex(*[radius + 1] * 3):
        if sum(errors) <= radius:
            a, b, c = (per_segment[s][e] for s, e in enumerate(errors))
            out += [(x << 24) | (y << 12) | z for x in a for y in b for z in c]
    return np.stack(out, axis=1)


def fingerprint(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: lower-cased in ASCII, a majority vote of the XXH64 of its word shingles.

    No words, or null: 0.  Fewer words than `shingle`: the whole sequence is the one shingle.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    take = min(shingle, len(words))
    starts = [0, *ends][: len(words) - take + 1]
    votes, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)], ends[at + take - 1 : at + take - 1 + (1 << 16)])
        h = np.array([xxhash.xxh64_intdigest(line[a : b - 1], seed) for a, b in spans], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(row, fp): the input row as a struct and its fingerprint as a signed long."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return _fingerprinted(rows, "row", kind, shingle)


def _fingerprinted(rows: DataFrame, keep: str, kind: str, shingle: int) -> DataFrame:
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b["text"]], dtype=np.uint64)
            yield pa.record_batch([b[keep], pa.array(fps.view(np.int64))], names=[keep, "fp"])

    return rows.select(keep, "text").mapInArrow(run, f"`{keep}` {kind}, fp long")


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(src, dst) over distinct fingerprints `fp`: enough links to join all that differ in at most max_bits bits.

    Rows of a key are sorted next to each other and read as a stream; every pair of them is verified by
    its bit distance and each key gives back at most one link per fingerprint, not the pairs.
    """

    def keys(batches):
        for b in batches:
            fp = b["fp"].to_numpy()
            for at in range(0, len(fp), 4096):
                part = fp[at : at + 4096]
                k = np.sort(fuzzy_keys(part.view(np.uint64), max_bits), axis=1)
                new = np.ones(k.shape, bool)
                new[:, 1:] = k[:, 1:] != k[:, :-1]
                row, _ = np.nonzero(new)
                yield pa.record_batch([k[new], part[row]], names=["key", "fp"])

    def link(batches):
        key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:
            key = np.concatenate([key, b["key"].to_numpy()])
            fp = np.concatenate([fp, b["fp"].to_numpy()])
            if not len(key):
                continue
            done = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            yield _links(key[:done], fp[:done], max_bits)
            key, fp = key[done:], fp[done:]
        yield _links(key, fp, max_bits)

    spread = fps.select("fp").mapInArrow(keys, "key long, fp long")
    sorted_keys = spread.repartition("key").sortWithinPartitions("key", "fp")
    return sorted_keys.mapInArrow(link, "src long, dst long").distinct()


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """One link per row to the smallest position of its local group; rows come sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(key)])
    words = fp.view(np.uint64)
    a, b = [], []
    small = np.repeat(sizes <= 64, sizes)
    for gap in range(1, int(sizes[sizes <= 64].max(initial=1))):
        i = np.flatnonzero(small[:-gap] & (key[gap:] == key[:-gap]))
        i = i[np.bitwise_count(words[i] ^ words[i + gap]) <= max_bits]
        a.append(i)
        b.append(i + gap)
    for start, size in zip(starts[sizes > 64], sizes[sizes > 64]):
        root = _group_roots(words[start : start + size], max_bits)
        a.append(start + np.arange(size))
        b.append(start + root)
    if a:
        root = local_roots(len(fp), np.concatenate(a), np.concatenate(b))
    else:
        root = np.arange(len(fp))
    away = np.flatnonzero(root != np.arange(len(fp)))
    return pa.record_batch([fp[away], fp[root[away]]], names=["src", "dst"])


def _group_roots(words: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots inside one large key group: block by block, or by trying every near word where that is less."""
    n = len(words)
    root = np.arange(n)
    if n <= 4096:
        for at in range(0, n, 1024):
            i, j = np.nonzero(np.bitwise_count(words[at : at + 1024, None] ^ words[None, at:]) <= max_bits)
            root = local_roots(n, np.r_[np.arange(n), at + i], np.r_[root, at + j])
        return root
    order = np.argsort(words)
    line = words[order]
    for e in range(1, max_bits + 1):
        for bits in combinations(range(64), e):
            near = line ^ np.uint64(sum(1 << b for b in bits))
            at = np.searchsorted(line, near) % n
            hit = np.flatnonzero(line[at] == near)
            root = local_roots(n, np.r_[np.arange(n), order[hit]], np.r_[root, order[at[hit]]])
    return root


def _per_fingerprint(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component): distinct fingerprints of `rows` and the smallest fingerprint each reaches."""
    distinct = staged(rows.select("fp").distinct(), "fps")
    groups = components(fingerprint_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    return distinct.join(groups, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id) for every row: texts whose fingerprints differ in at most max_bits bits link.

    fingerprint is 16 lower-case hex digits; component_id is the smallest id reachable over links.  Equal
    fingerprints are one node, so a hot group of copies costs one row after the first map-side count.

    Defined cases: null and empty texts have fingerprint zero and link like any other; a null id is never
    a component_id unless its whole component has no other; repeated rows come back as often as they came.
    max_bits 0 to 4.  Empty input gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    rows = staged(_fingerprinted(rows, "id", "bigint", shingle), "fingerprints")
    groups = staged(_per_fingerprint(rows, max_bits), "groups")
    least = rows.groupBy("fp").agg(F.min("id").alias("id")).join(groups, "fp")
    least = least.groupBy("component").agg(F.min("id").alias("component_id"))
    named = groups.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """The rows of `docs` that stay when each near-duplicate group keeps its smallest id (nulls last).

    Rows are told apart by their place in the written copy, so of rows that repeat an id one stays.
    """
    rows = with_fingerprints(docs, text_col, shingle).withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows, "rows")
    groups = _per_fingerprint(rows, max_bits)
    order = F.struct(F.col("row").getField(id_col).isNull(), F.col("row").getField(id_col), F.col("at"))
    first = rows.groupBy("fp").agg(F.min(order).alias("first")).join(groups, "fp")
    stays = first.groupBy("component").agg(F.min("first")["at"].alias("at")).select("at")
    return rows.join(stays, "at", "left_semi").select("row.*")
