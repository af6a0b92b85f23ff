"""Interpolated modified Kneser-Ney language model: counted in Spark, kept as sorted hash arrays, mapped by workers."""

from __future__ import annotations

import contextlib
import math
from dataclasses import dataclass, field
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of
from millrace.llm.files import mapped, new_file
from millrace.session import scratch_dir, staged

U64 = np.uint64
STEP = 0x9E3779B97F4A7C15  # odd multiplier of the word hash
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)  # fixed values of a public 64-bit finalizer
UNMIX = tuple(pow(m, -1, 1 << 64) for m in MIX)
END = U64(0)  # hash of the token that ends every text; no word has it
CHUNK = 2 << 20  # bytes of text whose words are looked up at a time
PIECE = 1 << 18  # bytes of text that are split at a time
HELD = 4 << 20  # distinct words or pairs a task holds before it hands them on; of longer grams, which hardly repeat, a quarter
PART = 1 << 20  # words, or grams of one order, whose statistics one task adds up
GATHERED = 1 << 18  # grams of all runs that are added up at a time
ROW = 1 << 15  # grams a row carries: the JVM holds a value of more than half a region of its heap in regions of its own
SENT = 1 << 20  # bytes of rows that leave a worker at a time
SLICE = 1 << 19  # grams whose place in the orders below is looked up at a time
BIG = 255  # counts from here on are kept beside the byte array

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads them evenly."""
    x = x ^ (x >> U64(33))
    x = x * U64(MIX[0])
    x = x ^ (x >> U64(33))
    x = x * U64(MIX[1])
    return x ^ (x >> U64(33))


def unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x = x * U64(UNMIX[1])
    x = x ^ (x >> U64(33))
    x = x * U64(UNMIX[0])
    return x ^ (x >> U64(33))


def _powers(n: int) -> list[np.ndarray]:
    """STEP ** i and its inverse, for i up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        _POWERS[:] = []
        for base in (STEP, pow(STEP, -1, 1 << 64)):
            line = np.full(max(n, PIECE) + 1, base, U64)
            line[0] = 1
            _POWERS.append(np.multiply.accumulate(line))
    return _POWERS


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens per text) of binary UTF-8 texts; each text ends in END.

    Words are runs of anything but ASCII white space, lower-cased in ASCII.  A word's hash is a polynomial
    in its bytes, taken for all words at once as differences of one running sum.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, ends = int(ends[0]), ends - ends[0]
    size = int(ends[-1])
    data = texts.buffers()[2]
    raw = _LOWER[np.frombuffer(data, np.uint8, size, low)] if size else np.empty(0, np.uint8)
    white = _WHITE[raw]
    cut = np.zeros(size + 1, bool)
    cut[ends] = True
    before = np.r_[True, white[:-1]] | cut[:-1] if size else white
    after = np.r_[white[1:], True] | cut[1:] if size else white
    first = np.flatnonzero(~white & before)
    last = np.flatnonzero(~white & after) + 1
    up, down = _powers(size)
    running = np.zeros(size + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * down[:size], out=running[1:])
    words = mix((running[last] - running[first]) * up[first])
    words[words == END] = U64(1)
    n = np.bincount(np.searchsorted(ends, first, side="right") - 1, minlength=len(texts)) if len(texts) else np.empty(0, np.int64)
    out = np.empty(len(words) + len(texts), U64)
    ending = np.zeros(len(out), bool)
    ending[np.cumsum(n + 1) - 1] = True
    out[ending], out[~ending] = END, words
    return out, n + 1


def chunks(batches):
    """(batch slice, token hashes, tokens per text) for slices of about CHUNK bytes; a text is never cut."""
    for part in pieces_of(batches, "text", CHUNK):
        tokens, n = zip(*(split(p["text"]) for p in pieces_of([part], "text", PIECE)))
        yield part, np.concatenate(tokens), np.concatenate(n)


def add_up(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order and the sum of their counts."""
    if not grams:
        return np.empty(0, U64), np.empty(0, np.int64)
    all_grams, all_counts = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(all_grams, kind="stable")
    all_grams = all_grams[order]
    starts = np.flatnonzero(np.r_[True, all_grams[1:] != all_grams[:-1]]) if len(order) else np.empty(0, np.int64)
    return all_grams[starts], np.add.reduceat(all_counts[order], starts) if len(starts) else np.empty(0, np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers as a byte that says how many bytes they need, then all lowest bytes, all next ones, and so on."""
    need = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([need]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :need].T.tobytes()


def _packed(rising: np.ndarray, *beside: np.ndarray) -> bytes:
    """The first of the rising numbers and how many there are, the steps between them, and what stands beside each."""
    steps = np.diff(rising, prepend=rising[:1])
    return b"".join([rising[:1].astype("<u8").tobytes(), len(rising).to_bytes(4, "little"), *map(_planes, (steps, *beside))])


def _unpacked(blob) -> list[np.ndarray]:
    data = np.frombuffer(blob, np.uint8)
    n, at, out = int.from_bytes(data[8:12].tobytes(), "little"), 12, []
    while at < len(data):
        need = int(data[at])
        planes = data[at + 1 : at + 1 + need * n].reshape(need, n)
        at += 1 + need * n
        if need == 1:
            out.append(planes[0])
        else:
            x = np.zeros((n, 8), np.uint8)
            x[:, :need] = planes.T
            out.append(x.view("<u8").ravel())
    return [np.cumsum(out[0], dtype=U64) + U64(int.from_bytes(data[:8].tobytes(), "little")), *out[1:]]


def _batches(rows, columns: dict[str, pa.DataType]):
    """Record batches of about SENT bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= SENT:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), columns.values())], names=list(columns))
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*held), columns.values())], names=list(columns))


def _hand_on(grams: np.ndarray, counts: np.ndarray, bits: int, width: int):
    """Rows (bucket, grams): sorted grams and their counts, cut by the highest bits of the grams and after ROW of them."""
    cuts = np.searchsorted(grams, np.array([b << (width - bits) for b in range(1, 1 << bits)], U64)) if bits else []
    rows = (
        (i, _packed(g[at : at + ROW], c[at : at + ROW]))
        for i, (g, c) in enumerate(zip(np.split(grams, cuts), np.split(counts, cuts)))
        for at in range(0, len(g), ROW)
    )
    yield from _batches(rows, {"bucket": pa.int32(), "grams": pa.binary()})


def counted(texts: DataFrame, grams_of, bits: int, width: int, most: int) -> DataFrame:
    """(bucket, grams): gram counts of each task, added up before they move."""

    def run(batches):
        runs, held = [], 0
        for _, tokens, n in chunks(batches):
            g, c = np.unique(grams_of(tokens, n), return_counts=True)
            runs.append((g, c.astype(np.min_scalar_type(int(c.max(initial=0))))))
            held += len(g)
            if held > 2 * most:
                runs = list(_added(runs))
                held = sum(len(g) for g, _ in runs)
                if held > most:
                    for g, c in runs:
                        yield from _hand_on(g, c, bits, width)
                    runs, held = [], 0
        for g, c in _added(runs):
            yield from _hand_on(g, c, bits, width)

    return texts.mapInArrow(run, "bucket int, grams binary")


def _added(runs: list[tuple[np.ndarray, np.ndarray]]):
    """(distinct grams in order, sum of their counts) of runs of sorted grams and their counts, range by range.

    A range is a slice of each run, about GATHERED entries together; equal grams never fall into two ranges.
    """
    if not runs:
        return
    step = 64
    marks = np.sort(np.concatenate([g[::step] for g, _ in runs]))
    cuts = np.unique(marks[GATHERED // step :: GATHERED // step])
    cuts = [np.r_[0, np.searchsorted(g, cuts), len(g)] for g, _ in runs]
    for i in range(len(cuts[0]) - 1):
        yield add_up([g[c[i] : c[i + 1]] for (g, _), c in zip(runs, cuts)], [n[c[i] : c[i + 1]].astype(np.int64) for (_, n), c in zip(runs, cuts)])


def _write(folder: str, name: str, *arrays: np.ndarray, suffix: str = ".bin") -> list[str]:
    out = []
    for i, a in enumerate(arrays):
        uri, f = new_file(folder, f"{name}-{i}", suffix)
        with f:
            f.write(np.ascontiguousarray(a))
        out.append(uri)
    return out


class Sorted:
    """A sorted array of hashes or numbers over several files, by the highest of its bits, with counts beside it."""

    def __init__(self, files: list[tuple[int, list[str]]], bits: int, width: int):
        self.bits, self.width, self.parts, self.first, at = bits, width, {}, {}, 0
        for bucket, (grams, small, place, big) in sorted(files):
            self.parts[bucket] = mapped(grams, U64), mapped(small, np.uint8), mapped(place, np.int64), mapped(big, np.int64)
            self.first[bucket] = at
            at += len(self.parts[bucket][0])
        self.buckets, self.starts = list(self.first), np.array([*self.first.values(), at])

    def slices(self, bucket: int):
        """(position of the first, grams, counts) of a bucket, SLICE at a time."""
        grams, small, place, big = self.parts[bucket]
        for at in range(0, len(grams), SLICE):
            counts = small[at : at + SLICE].astype(np.int64)
            a, b = np.searchsorted(place, (at, at + SLICE))
            counts[place[a:b] - at] = big[a:b]
            yield self.first[bucket] + at, np.asarray(grams[at : at + SLICE]), counts

    def at(self, places: np.ndarray) -> np.ndarray:
        """The grams at sorted positions."""
        out = np.empty(len(places), U64)
        cuts = np.searchsorted(places, self.starts)
        for bucket, start, a, b in zip(self.buckets, self.starts, cuts, cuts[1:]):
            if a < b:
                out[a:b] = self.parts[bucket][0][places[a:b] - start]
        return out

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position or -1, count) of each gram; the grams come sorted, so reads go one way through the files."""
        where, count = np.full(len(grams), -1, np.int64), np.zeros(len(grams), np.int64)
        buckets = (grams >> U64(self.width - self.bits)).astype(np.int64) if self.bits else np.zeros(len(grams), np.int64)
        starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if len(grams) else []
        for a, b in zip(starts, [*starts[1:], len(grams)]):
            if buckets[a] not in self.parts:
                continue
            line, small, place, big = self.parts[buckets[a]]
            i = np.minimum(np.searchsorted(line, grams[a:b]), len(line) - 1)
            hit = line[i] == grams[a:b]
            n = small[i].astype(np.int64)
            large = hit & (n == BIG)
            n[large] = big[np.searchsorted(place, i[large])]
            where[a:b] = np.where(hit, i + self.first[buckets[a]], -1)
            count[a:b] = np.where(hit, n, 0)
        return where, count

    def find_all(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        line, back = np.unique(grams, return_inverse=True)
        where, count = self.find(line)
        return where[back], count[back]


def _count_arrays(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = np.flatnonzero(counts >= BIG)
    return np.minimum(counts, BIG).astype(np.uint8), place.astype(np.int64), counts[place].astype(np.int64)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more from the counts of counts; halves where a corpus is too small to tell."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05 * (k + 1)), k + 1.0) for k, d in enumerate(raw))


@dataclass
class Model:
    """Where the model's files are, and its few global numbers; lists and dicts go by the order of a gram, from 1.

    A gram is known by its position in the sorted array of its order.  A pair is two word numbers, mixed; a
    longer gram is the position of all but its last word, and the number of that word.
    """

    order: int
    grams: dict[int, list[tuple[int, list[str]]]]
    bits: dict[int, int]  # that tell the buckets of an order apart
    parts: dict[int, list[tuple[int, list[str]]]]
    texts: int  # texts it learnt from
    tokens: int
    sizes: dict[int, int]  # different grams
    cuts: dict[int, tuple[float, float, float]]  # discounts
    part: int  # grams whose statistics are in one set of files
    kinds: tuple[int, int, int] = (0, 0, 0)  # words that follow 1, 2, 3 or more different ones
    loaded: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "loaded": {}}

    @property
    def types(self) -> int:
        return self.sizes.get(1, 0)

    @property
    def pair_bits(self) -> int:
        return self.bits[2]

    def width(self, k: int) -> int:
        """Bits of the numbers that stand for grams."""
        if k < 3:
            return 64
        width = self.types.bit_length() + self.sizes[k - 1].bit_length()
        if width > 64:
            raise OverflowError(f"more different words and grams of {k - 1} than 64 bits can number together")
        return width

    def level(self, k: int) -> Sorted:
        """The mapped grams of an order; a worker opens them once."""
        if ("grams", k) not in self.loaded:
            key = ("grams", k, str(self.grams[k]))
            if key not in _OPEN:
                _OPEN[key] = Sorted(self.grams[k], self.bits[k], self.width(k))
            self.loaded["grams", k] = _OPEN[key]
        return self.loaded["grams", k]

    def columns(self, k: int) -> dict[int, list[np.ndarray]]:
        if ("parts", k) not in self.loaded:
            key = ("parts", k, str(self.parts[k]))
            if key not in _OPEN:
                _OPEN[key] = {p: [mapped(u, u.rsplit(".", 2)[1]) for u in f] for p, f in self.parts[k]}
            self.loaded["parts", k] = _OPEN[key]
        return self.loaded["parts", k]

    def statistics(self, k: int, places: np.ndarray, columns=range(5)) -> np.ndarray:
        """Of each gram of order k, in rising order: (different words before it; sum of the adjusted counts of the
        grams that it begins; how many of those have 1, 2, 3 or more)."""
        out = np.zeros((len(columns), len(places)), np.int64)
        part = places // self.part
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        files = self.columns(k) if k in self.parts else {}
        for a, b in zip(starts, [*starts[1:], len(part)]):
            if part[a] in files:
                at = places[a:b] % self.part
                for i, c in enumerate(columns):
                    out[i, a:b] = files[part[a]][c][at]
        return out

    def adjusted(self, k: int, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The counts that gram probabilities of an order go by: below the highest, different words before a gram.

        Nothing comes before a gram from the start of a text; it keeps its count.
        """
        if k == self.order:
            return counts
        before = self.statistics(k, places, (0,))[0]
        return np.where(before > 0, before, counts)

    def numbers(self, k: int, context: np.ndarray, words: np.ndarray) -> np.ndarray:
        context, words = context.astype(U64), words.astype(U64)
        return mix((context << U64(32)) | words) if k == 2 else (context << U64(self.types.bit_length())) | words

    def taken_apart(self, k: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of all but the last word, last word) of grams."""
        low = U64(32 if k == 2 else self.types.bit_length())
        numbers = unmix(numbers) if k == 2 else numbers
        return (numbers >> low).astype(np.int64), (numbers & ((U64(1) << low) - U64(1))).astype(np.int64)

    def without_first(self, k: int, context: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The positions, one order lower, of grams without their first word."""
        if k == 2:
            return words
        line, back = np.unique(context, return_inverse=True)
        shorter = self.without_first(k - 1, *self.taken_apart(k - 1, self.level(k - 1).at(line)))
        return self.level(k - 1).find_all(self.numbers(k - 1, shorter[back], words))[0]

    def contexts(self, k: int, below: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each token the position of the k - 1 words before it, or -1; `below` has those that end in each token.

        The number after all words stands for the start of a text; nothing is before that.
        """
        out = np.roll(below, 1)
        out[np.cumsum(n) - n] = self.types if k == 2 else -1
        return out

    def walk(self, tokens: np.ndarray, n: np.ndarray, order: int):
        """(order, position or -1 of the gram that ends in each token, (tokens it can end in, which of the different
        grams theirs is, position or -1 and count of each of those)) of each order.

        Different grams come in rising order, so what is read of them is read one way through the files.
        """
        ids = below = None
        for k in range(1, order + 1):
            known, numbers = np.full(len(tokens), bool(k == 1 or self.grams.get(k))), tokens
            if k > 1:
                context = self.contexts(k, below, n)
                known &= (context >= 0) & (ids >= 0)
                numbers = self.numbers(k, context[known], ids[known])
            line, back = np.unique(numbers, return_inverse=True)
            where, count = self.level(k).find(line) if len(line) else (np.empty(0, np.int64),) * 2
            below = _spread(where, back, known, -1)
            ids = below if k == 1 else ids
            yield k, below, (known, back, where, count)

    def log10(self, tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 P of every token after the ones before it, its count in training)."""
        least, firsts = 1 / (self.types + 1), np.cumsum(n) - n
        for k, _, (known, back, where, count) in self.walk(tokens, n, self.order):
            there = where >= 0
            about = np.zeros((5, len(where)), np.int64)
            if k < self.order:
                about[:, there] = self.statistics(k, where[there])
            if k == 1:
                tally = _spread(count, back, known, 0)
                p = np.full(len(tokens), least)
                if follow := self.sizes.get(2, 0):
                    spare = sum(d * m for d, m in zip(self.cuts[1], self.kinds)) / follow
                    p = ((about[0] - _cut(about[0], self.cuts[1])) / follow + spare * least)[back]
            else:
                a = np.where(about[0] > 0, about[0], count)
                own = _spread(a - _cut(a, self.cuts[k]), back, known, 0)
                p = np.where(total > 0, (own + spares * p) / np.maximum(total, 1), p)
            if k < self.order:  # what the gram before a token says of the words after it
                start = self.statistics(1, np.array([self.types]))[1:, 0] if k == 1 else np.zeros(4, np.int64)
                total = np.roll(_spread(about[1], back, known, 0), 1)
                spares = np.roll(_spread(_spare(about[2:], self.cuts[k + 1]), back, known, 0), 1)
                total[firsts], spares[firsts] = start[0], _spare(start[1:], self.cuts[k + 1])
        return np.log10(p), tally


def _spread(values: np.ndarray, back: np.ndarray, known: np.ndarray, missing) -> np.ndarray:
    """The values of different grams, for each token."""
    out = np.full(len(known), missing, values.dtype)
    out[known] = values[back]
    return out


def _spare(begins: np.ndarray, discount: tuple[float, float, float]):
    return sum(d * b for d, b in zip(discount, begins))


def _cut(counts: np.ndarray, discount: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts >= 3, counts == 2, counts == 1], discount[::-1], 0.0)


_OPEN: dict = {}


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count the grams of up to `order` words of all texts of `docs` and write the model below the shared folder.

    Words are numbered by their place in the sorted array of word hashes; longer grams are numbers of 64 bits
    made of the position of all but the last word and of that word, so only words are told apart by hash.
    Each task adds its grams up and hands them on sorted, as steps, cut into buckets: a hot gram is one
    entry a task.  A bucket becomes one file.  The number of buckets follows the bytes of text, so each
    stays the same size as the corpus grows.  A text starts with one sign of its own and ends in END; grams
    that would begin before that are left out.  Below the highest order a gram counts by the different
    words before it, or if it begins with the start, by its count.
    Null texts are empty texts; no texts give a model in which everything is equally likely.
    """
    if order < 2:
        raise ValueError("a model needs pairs at least")
    spark = docs.sparkSession
    folder = scratch_dir(spark, "ngrams")
    rows = docs.select(F.col(text_col).cast("binary").alias("text"))
    texts, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    whole = {k: math.ceil(math.log2(max(size, 1) / ((256, 48, 24)[min(k, 3) - 1] << 20))) for k in range(1, order + 1)}
    half = (0.5, 1.0, 1.5)
    model = Model(order, {}, {k: max(0, b) for k, b in whole.items()}, {}, texts, 0, {}, {k: half for k in whole}, PART)

    for k in range(1, order + 1):
        model.bits[k] = min(model.bits[k], model.width(k))

        found = counted(rows, _grams_of(model, k), model.bits[k], model.width(k), HELD if k < 3 else HELD // 4)
        found = found.groupBy("bucket").applyInArrow(_bucket_writer(f"grams{k}", folder), "bucket int, files array<string>, types long, tokens long")
        found = staged(found, f"grams{k}").collect()  # a row per file
        model.grams[k], model.sizes[k] = [(r["bucket"], r["files"]) for r in found], sum(r["types"] for r in found)
        if k == 1:
            model.tokens = sum(r["tokens"] for r in found)
            if model.types >= (1 << 32) - 1:
                raise OverflowError("more words than 32 bits can number")
        model.loaded = {}

    for k in range(order, 1, -1):
        if not model.grams[k]:
            continue
        buckets = spark.createDataFrame([(b,) for b, _ in model.grams[k]], "bucket int")
        traced = buckets.repartition(len(model.grams[k]), "bucket").mapInArrow(_traced(model, k), TRACED)
        parts = staged(traced.groupBy("part").applyInArrow(_part_writer(model, k - 1, folder), PARTS), f"parts{k - 1}")
        parts = parts.collect()  # a row per PART grams
        model.parts[k - 1] = [(r["part"], r["files"]) for r in parts]
        model.cuts[k] = discounts(*[sum(r["kinds"][i] for r in parts) for i in range(4)])
        model.loaded = {}
        if k == 2:
            kinds = [sum(r["before"][i] for r in parts) for i in range(5)]
            model.cuts[1] = discounts(*kinds[:4])
            model.kinds = kinds[0], kinds[1], sum(kinds[2:])
    return model


def _bucket_writer(name: str, folder: str):
    def write(table: pa.Table) -> pa.Table:
        bucket, types, tokens = table["bucket"][0].as_py(), 0, 0
        with contextlib.ExitStack() as opened:
            uris, files = zip(*[new_file(folder, f"{name}-{bucket:06d}-{i}", ".bin") for i in range(4)])
            for f in files:
                opened.enter_context(f)
            for grams, counts in _added([_unpacked(x.as_buffer()) for x in table["grams"]]):
                small, place, big = _count_arrays(counts)
                for f, a in zip(files, (grams, small, place + types, big)):
                    f.write(np.ascontiguousarray(a))
                types, tokens = types + len(grams), tokens + int(counts.sum())
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "files": [list(uris)], "types": [types], "tokens": [tokens]})

    return write


def _grams_of(model: Model, k: int):
    if k == 1:
        return lambda tokens, n: tokens

    def numbers(tokens, n):
        ids = below = None
        for j, place, _ in model.walk(tokens, n, k - 1):
            ids, below = (place if j == 1 else ids), place
        context = model.contexts(k, below, n)
        there = context >= 0
        return model.numbers(k, context[there], ids[there])

    return numbers


TRACED = "part int, kinds array<long>, before binary, begins binary"
TRACED_TYPES = {"part": pa.int32(), "kinds": pa.list_(pa.int64()), "before": pa.binary(), "begins": pa.binary()}
PARTS = "part int, files array<string>, kinds array<long>, before array<long>"


def _traced(model: Model, k: int):
    """Rows (part of order k - 1, counts of counts, words before, grams begun) of what SLICE grams of a bucket add."""

    def rows(first, numbers, counts):
        counts = model.adjusted(k, first + np.arange(len(counts)), counts)
        context, words = model.taken_apart(k, numbers)
        before = _by_place(model.without_first(k, context, words))
        begins = _by_place(context, counts, counts == 1, counts == 2, counts >= 3)
        kinds = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()  # told once
        for p in np.union1d(before[0] // model.part, begins[0] // model.part).tolist():
            for b, g in zip_longest(*(_slices(x, p * model.part, model.part) for x in (before, begins)), fillvalue=b""):
                yield p, kinds, b, g
                kinds = [0] * 4

    def run(batches):
        buckets = (bucket for b in batches for bucket in b["bucket"].to_pylist())
        for bucket in buckets:
            for found in model.level(k).slices(bucket):
                yield from _batches(rows(*found), TRACED_TYPES)

    return run


def _by_place(place: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct places in order, and per place the sum of each of the values, or how often it came."""
    order = np.argsort(place, kind="stable")
    place = place[order]
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    sums = [np.add.reduceat(v[order].astype(np.int64), starts) for v in values] or [np.diff(np.r_[starts, len(place)])]
    return [place[starts], *sums]


def _slices(sums: list[np.ndarray], first: int, size: int):
    """What falls into a part, ROW places at a time."""
    a, b = np.searchsorted(sums[0], (first, first + size)).tolist()
    for at in range(a, b, ROW):
        places, *others = (x[at : min(at + ROW, b)] for x in sums)
        yield _packed(places - first, *others)


def _part_writer(model: Model, k: int, folder: str):
    def write(table: pa.Table) -> pa.Table:
        p = table["part"][0].as_py()
        total = np.zeros((5, min(model.part, model.sizes[k] + 1 - p * model.part)), np.int64)
        for name, lines in (("before", total[:1]), ("begins", total[1:])):
            for blob in table[name]:
                if blob.as_buffer().size:
                    places, *sums = _unpacked(blob.as_buffer())
                    for line, x in zip(lines, sums):
                        line[places.view(np.int64)] += x.astype(np.int64)
        uris = []
        for i, line in enumerate(total):
            kind = np.min_scalar_type(int(line.max(initial=0)))
            uris += _write(folder, f"part{k}-{p:06d}-{i}", line.astype(kind), suffix=f".{kind}.bin")
        kinds = np.array(table["kinds"].to_pylist()).sum(0).tolist()
        before = np.bincount(np.minimum(total[0], 5), minlength=6)[1:].tolist()
        types = (pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip((p, uris, kinds, before), types)], names=[c.split()[0] for c in PARTS.split(", ")])

    return write


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every text, whole; null texts are the end token alone.

    score is the sum of log10 probabilities under the model; base_score that of add-one word counts.  Rows
    that repeat come as often, a null id stays null, other columns do not matter.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = model.tokens + model.types + 1

    def run(batches):
        for part, tokens, n in chunks(batches):
            logs, count = shared.value.log10(tokens, n)
            at = np.cumsum(n) - n
            known = np.add.reduceat((count > 0).astype(np.int64), at)
            base = np.add.reduceat(np.log10((count + 1) / whole), at)
            yield pa.record_batch(
                [part["id"], pa.array(n.astype(np.int64)), pa.array(known), pa.array(base), pa.array(np.add.reduceat(logs, at))],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

    return rows.mapInArrow(run, "id long, n_tokens long, n_known long, base_score double, score double")
