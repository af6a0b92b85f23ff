"""Phrase collocations by stripes: every prefix keys a counter of the words that follow it."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of
from millrace.llm.files import mapped, new_file
from millrace.llm.ngram import mix
from millrace.session import scratch_dir, staged

NO_LANG = "und"
CHUNK = 1 << 18  # bytes of text split at a time
HELD = 1 << 19  # entries of counters a task holds before it hands them on
MERGED = 1 << 18  # entries merged at a time
BLOCKS, BLOCK = 1 << 13, 1 << 18  # blocks that stripes are dealt in: at least so many, and one for so many words
SHARE = 1 << 16  # occurrences of a prefix that go with one part of its stripe
I64, U64 = np.int64, np.uint64

WORD, SOFT, HARD = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = SOFT
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = HARD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: What a byte adds to the two halves of a word's 128-bit hash, by place in the word (the place beyond 256 multiplies).
_ADDS = [mix((np.arange(1 << 16, dtype=U64) + U64(1)) * U64(m)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


@dataclass
class Tokens:
    """Words of some texts in order: their bytes one behind the other, and the text and piece of each."""

    data: np.ndarray
    ends: np.ndarray  # of the words, with a 0 in front
    text: np.ndarray
    piece: np.ndarray

    def words(self) -> pa.Array:
        buffers = [None, pa.py_buffer(self.ends.astype(I64)), pa.py_buffer(self.data)]
        return pa.Array.from_buffers(pa.large_string(), len(self.ends) - 1, buffers)

    def hashes(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of every word under the seed of its text; 128 bits tell words apart at any size."""
        if not len(self.data):
            return np.empty(0, I64), np.empty(0, I64)
        starts = self.ends[:-1]
        place = np.arange(len(self.data)) - np.repeat(starts, np.diff(self.ends))
        index, out = ((place & 255) << 8) | self.data, []
        far = place > 255
        times = (2 * (place[far] >> 8) + 1).astype(U64)
        for i, adds in enumerate(_ADDS):
            add = adds[index]
            add[far] *= times
            out.append(mix(np.add.reduceat(add, starts) ^ seeds[i][self.text]).view(I64))
        return tuple(out)


def split(texts: pa.Array) -> Tokens:
    """Words of binary UTF-8 texts in ASCII lower case; a piece ends with its text and at every HARD byte."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], I64)[texts.offset : texts.offset + len(texts) + 1]
    low, size = int(ends[0]), int(ends[-1] - ends[0])
    raw = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8, size, low)] if size else np.empty(0, np.uint8)
    kind = _CLASS[raw]
    inside = kind == WORD
    cut = np.zeros(size + 1, bool)
    cut[ends - low] = True
    first = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | cut[:-1])) if size else np.empty(0, I64)
    last = np.flatnonzero(inside & (np.r_[~inside[1:], True] | cut[1:])) + 1 if size else np.empty(0, I64)
    text = np.searchsorted(ends - low, first, side="right") - 1
    return Tokens(raw[inside], np.concatenate([[0], np.cumsum(last - first)]), text, np.cumsum(kind == HARD)[first] + text if size else text)


def lang_seeds(langs: pa.Array) -> np.ndarray:
    """Two seeds of every language name."""
    names = langs.dictionary_encode()
    plain = split(pa.array([x.encode().hex() for x in names.dictionary.to_pylist()], pa.binary()))
    of = np.zeros((2, len(names.dictionary)), U64)
    of[:, plain.text] = [x.view(U64) for x in plain.hashes(np.ones((2, len(names.dictionary)), U64))]
    return of[:, names.indices.to_numpy(zero_copy_only=False)]


def key_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.view(U64) ^ mix(b.view(U64) + U64(1))).view(I64)


@dataclass
class Table:
    """Frequent grams in order of their hash, in files that workers map; a gram's id is its place.

    A gram is two numbers: the halves of a word's hash, or the id of its prefix and that of its last word.
    """

    uris: list[str]
    firsts: np.ndarray  # least hash of each file
    offsets: np.ndarray  # ids before each file, and all
    maps: list = field(default_factory=list, repr=False)

    def __len__(self) -> int:
        return int(self.offsets[-1])

    def __getstate__(self):
        return {**self.__dict__, "maps": []}

    def file(self, k: int) -> np.ndarray:
        """[hash, a, b, count] of a file's grams."""
        if not self.maps:
            self.maps = [None] * len(self.uris)
        if self.maps[k] is None:
            self.maps[k] = mapped(self.uris[k], I64).reshape(4, -1)
        return self.maps[k]

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids of grams, -1 where there is none."""
        out, h = np.full(len(a), -1, I64), key_hash(a, b)
        if not len(self):
            return out
        which = np.searchsorted(self.firsts, h, side="right") - 1
        for k in np.unique(which[which >= 0]):
            hashes, left, right, _ = self.file(k)
            rows = np.flatnonzero(which == k)
            at = np.searchsorted(hashes, h[rows])
            while len(rows):  # again only where two grams share a hash
                ok = at < len(hashes)
                rows, at = rows[ok], at[ok]
                ok = hashes[at] == h[rows]
                rows, at = rows[ok], at[ok]
                hit = (left[at] == a[rows]) & (right[at] == b[rows])
                out[rows[hit]] = self.offsets[k] + at[hit]
                rows, at = rows[~hit], at[~hit] + 1
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        out, which = np.zeros(len(ids), I64), np.searchsorted(self.offsets, ids, side="right") - 1
        for k in np.unique(which):
            rows = which == k
            out[rows] = self.file(k)[3][ids[rows] - self.offsets[k]]
        return out


def write_table(grams: DataFrame) -> tuple[DataFrame, Table]:
    """(grams with their id, the table) of a frame with a, b and n: dealt in ranges of the hash, one file a task."""
    folder, spark = scratch_dir(grams.sparkSession, "grams"), grams.sparkSession
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grams.schema)

    def hashed(batches):
        for b in batches:
            yield b.append_column("h", pa.array(key_hash(b["a"].to_numpy(), b["b"].to_numpy())))

    def write(batches):
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        uri, out = new_file(folder, "grams", ".bin")
        with out:
            for c in ("h", "a", "b", "n"):
                out.write(rows[c].to_numpy().astype(I64).tobytes())
        part = np.full(rows.num_rows, TaskContext.get().partitionId(), np.int32)
        rows = rows.append_column("at", pa.array(np.arange(len(part)))).append_column("part", pa.array(part))
        once = pa.concat_arrays([pa.array([uri]), pa.nulls(len(part) - 1, pa.string())])
        yield from rows.append_column("uri", once).to_batches(max_chunksize=1 << 14)

    dealt = grams.mapInArrow(hashed, f"{kinds}, h long").repartitionByRange("h").sortWithinPartitions("h", "a", "b")
    rows = staged(dealt.mapInArrow(write, f"{kinds}, h long, at long, part int, uri string"), "grams")
    files = rows.groupBy("part").agg(F.max("uri").alias("uri"), F.min("h").alias("h"), F.count("*").alias("n")).collect()
    files.sort(key=lambda r: r["h"])
    offsets = np.concatenate([[0], np.cumsum([r["n"] for r in files], dtype=I64)]).astype(I64)
    table = Table([r["uri"] for r in files], np.array([r["h"] for r in files], I64), offsets)
    starts = spark.createDataFrame([(r["part"], int(o)) for r, o in zip(files, offsets)], "part int, start long")
    return rows.join(starts, "part").withColumn("id", F.col("start") + F.col("at")).drop("h", "uri", "at", "part", "start"), table


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n): the stripe of the empty prefix; a null word counts all words of its language."""

    def run(batches):
        held, size = [], 0
        for part in pieces_of(batches, "text", CHUNK):
            part = part.take(pc.sort_indices(part["lang"]))
            tokens, langs = split(part["text"]), part["lang"].to_pylist()
            words = tokens.words()
            starts = np.flatnonzero(np.array([i == 0 or langs[i] != langs[i - 1] for i in range(len(langs))]))
            cuts = np.searchsorted(tokens.text, [*starts, len(langs)])
            for i, lo, hi in zip(starts, cuts, cuts[1:]):
                found = words.slice(lo, hi - lo).value_counts()
                word = pa.concat_arrays([found.field("values"), pa.nulls(1, pa.large_string())])
                n = pa.concat_arrays([found.field("counts"), pa.array([hi - lo], pa.int64())])
                held.append(pa.table({"lang": pa.array([langs[i]]).take(pa.array(np.zeros(len(n), I64))), "word": word, "n": n}))
                size += len(n)
            if size > HELD:
                held = [_summed(held)]
                size = held[0].num_rows
                if size > HELD // 2:
                    yield from _plain(held.pop())
                    size = 0
        if held:
            yield from _plain(_summed(held))

    found = rows.mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _summed(held: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(held).group_by(["lang", "word"]).aggregate([("n", "sum")]).rename_columns(["lang", "word", "n"])


def _plain(table: pa.Table):
    for b in table.to_batches(max_chunksize=1 << 16):
        yield pa.record_batch([b["lang"], b["word"].cast(pa.string()), b["n"]], names=["lang", "word", "n"])


def _with_hashes(words: DataFrame) -> DataFrame:
    """(lang, word, n, a, b): the halves of each word's hash under its language."""

    def run(batches):
        for b in batches:
            found = split(b["word"].cast(pa.binary())).hashes(lang_seeds(b["lang"]))
            yield pa.record_batch([*b.columns, *map(pa.array, found)], names=["lang", "word", "n", "a", "b"])

    return words.select("lang", "word", "n").mapInArrow(run, "lang string, word string, n long, a long, b long")


def distinct(prefix: np.ndarray, nxt: np.ndarray, n: np.ndarray | None = None):
    """Distinct (prefix, next) in order and the sum of their counts (1 each, if none are given)."""
    if not len(prefix):
        return prefix, nxt, np.empty(0, I64)
    width = int(nxt.max()).bit_length()
    if int(prefix.max()).bit_length() + width <= 63:
        key = (prefix << width) | nxt
        if n is None:
            key = np.sort(key)
        else:
            order = np.argsort(key)
            key, n = key[order], n[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        prefix, nxt = key[starts] >> width, key[starts] & ((1 << width) - 1)
        size = len(key)
    else:
        order = np.lexsort((nxt, prefix))
        prefix, nxt, n = prefix[order], nxt[order], None if n is None else n[order]
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (nxt[1:] != nxt[:-1])])
        size, prefix, nxt = len(order), prefix[starts], nxt[starts]
    return prefix, nxt, np.diff(np.r_[starts, size]) if n is None else np.add.reduceat(n, starts)


def followers(part: pa.RecordBatch, tables: list[Table]) -> tuple[np.ndarray, np.ndarray]:
    """(prefix, next) at every place where a frequent gram as long as the tables go stands.

    next is the id of the following word plus 1, or 0 where the piece ends or the gram one word on is not
    frequent: then the longer gram cannot be either.
    """
    tokens = split(part["text"])
    words = tables[0].find(*tokens.hashes(lang_seeds(part["lang"])))
    grams, n = words, len(words)
    for j, table in enumerate(tables[1:], 2):
        at = _both(grams, tokens.piece, j - 1)
        longer = np.full(n, -1, I64)
        longer[at] = table.find(grams[at], words[at + j - 1])
        grams = longer
    at = np.flatnonzero(grams >= 0)
    nxt = np.zeros(n, I64)
    on = _both(grams, tokens.piece, len(tables))
    nxt[on] = words[on + len(tables)] + 1
    return grams[at], nxt[at]


def _both(grams: np.ndarray, piece: np.ndarray, size: int) -> np.ndarray:
    """Places where a known gram of `size` words is followed, in its piece, by the known gram one word on."""
    if len(grams) <= size:
        return np.empty(0, I64)
    ok = (grams[:-size] >= 0) & (grams[1 : len(grams) - size + 1] >= 0) & (piece[:-size] == piece[size:])
    return np.flatnonzero(ok)


def stripes(
    rows: DataFrame, tables: list[Table], least: int, tokens: int = 0, part_of: int = SHARE, hold: int = HELD, at_once: int = MERGED
) -> DataFrame:
    """(prefix, total, next, n): for every frequent gram the words that follow it at least `least` times, and all its occurrences.

    A task counts into stripes of its own and hands them on in blocks, dealt by prefix; the stripes of one
    prefix meet and are added up entry by entry.  There are more blocks the more `tokens` there are.  The
    stripe of a prefix with very many occurrences is cut into parts by its next words, one for every `part_of`
    of its count, which lie in blocks of their own; then `total` is that of the part.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tables)
    blocks = max(BLOCKS, tokens // BLOCK)

    def count(batches):
        held, size = [], 0
        for part in pieces_of(batches, "text", CHUNK):
            held.append(distinct(*followers(part, shared.value)))
            size += len(held[-1][0])
            if size > hold:
                held = [distinct(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size > hold // 2:
                    yield from _blocks(*held.pop(), shared.value[-1], part_of, blocks)
                    size = 0
        if held:
            yield from _blocks(*distinct(*map(np.concatenate, zip(*held))), shared.value[-1], part_of, blocks)

    def merge(batches):
        rest, size = [], 0
        for b in batches:
            rest.append(b)
            size += len(b["next"].flatten())
            if size > at_once:
                table = pa.Table.from_batches(rest)
                block = table["block"].to_numpy()
                done = int(np.flatnonzero(np.r_[True, block[1:] != block[:-1]])[-1])  # the last block may go on
                if done:
                    yield _merged(table.slice(0, done), least)
                    rest = table.slice(done).combine_chunks().to_batches()
                    size = sum(len(x["next"].flatten()) for x in rest)
        if rest:
            yield _merged(pa.Table.from_batches(rest), least)

    kinds = "block long, prefix array<long>, next array<long>, n array<long>"
    dealt = rows.mapInArrow(count, kinds).repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(merge, "prefix long, total long, next array<long>, n array<long>")


def _blocks(prefix: np.ndarray, nxt: np.ndarray, n: np.ndarray, table: Table, part_of: int, blocks: int):
    """Entries of stripes as rows: one for every block that has some."""
    if not len(prefix):
        return
    starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    sizes = np.diff(np.r_[starts, len(prefix)])
    parts = np.repeat(1 + table.counts(prefix[starts]) // part_of, sizes)
    part = mix(nxt.view(U64)) % parts.astype(U64)
    block = 2 * (mix(prefix.view(U64) + mix(part)) % U64(blocks)).astype(I64) + (parts > 1)  # stripes in parts have odd blocks
    order = np.argsort(block, kind="stable")
    block = block[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    ends = pa.array(np.r_[starts, len(block)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (prefix, nxt, n)]
    out = pa.record_batch([pa.array(block[starts]), *lists], names=["block", "prefix", "next", "n"])
    yield from (out.slice(at, 1 << 10) for at in range(0, len(out), 1 << 10))


def _merged(table: pa.Table, least: int) -> pa.RecordBatch:
    """Stripes with an entry that counts, and all that come in parts, as another part may have one."""
    odd = np.repeat(table["block"].to_numpy() & 1, pc.list_value_length(table["prefix"]).to_numpy()) > 0
    prefix, nxt, n = (pc.list_flatten(table[c]).combine_chunks().to_numpy() for c in ("prefix", "next", "n"))
    in_parts = np.unique(prefix[odd])
    prefix, nxt, n = distinct(prefix, nxt, n)
    starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
    total = np.add.reduceat(n, starts)
    many = (n >= least) & (nxt > 0)
    kept = np.add.reduceat(many.astype(I64), starts)
    stay = (kept > 0) | np.isin(prefix[starts], in_parts)
    ends = np.concatenate([[0], np.cumsum(kept[stay])]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (nxt[many] - 1, n[many])]
    return pa.record_batch([pa.array(prefix[starts][stay]), pa.array(total[stay]), *lists], names=["prefix", "total", "next", "n"])


def _longer(found: DataFrame, grams: DataFrame, shorter: DataFrame, first: DataFrame | None) -> DataFrame:
    """Grams one word longer, with phrase, last word and the counts of all first parts and rests.

    `shorter` describes the grams of the length before, `first` is None where those are words.  A gram's
    rest behind its first word is the gram of its prefix's rest and its own last word.
    """
    totals = found.groupBy("prefix").agg(F.sum("total").alias("total"))
    p = shorter.select(F.col("id").alias("prefix"), "lang", "phrase", "firsts", F.col("suffix").alias("between"))
    out = grams.select("id", F.col("a").alias("prefix"), F.col("b").alias("next"), "n").join(p, "prefix").join(totals, "prefix")
    s = shorter.select(F.col("id").alias("suffix"), F.col("n").alias("rest"), "last", "rests", F.col("prefix").alias("between"), "next")
    if first is None:
        out = out.drop("between").join(s.select(F.col("suffix").alias("next"), "suffix", "rest", "last", "rests"), "next")
    else:
        out = out.join(s, ["between", "next"])
    return out.select(
        "id", "lang", "prefix", "next", "suffix", "n", "last",
        F.concat_ws(" ", "phrase", "last").alias("phrase"),
        F.concat("firsts", F.array("total")).alias("firsts"),
        F.concat(F.array("rest"), "rests").alias("rests"),
    )


def _lowest_cut(factor: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score, ties to the first; whole numbers of 38 digits throughout."""
    score = f"CAST(CAST(n AS DECIMAL(20,0)) * {factor} div CAST(firsts[i - 1] + rests[i - 1] AS DECIMAL(20,0)) AS LONG)"
    cut = f"named_struct('score', {score}, 'k', i, 'l', firsts[i - 1], 'r', rests[i - 1])"
    return F.expr(f"array_min(transform(sequence(1, size(firsts)), i -> {cut}))")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    words: int = 4,
    least: int = 30,
    share: int = 80,
    factor: int = 2_000_000,
    most: int = 2000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `most` phrases of 2 to `words` words.

    A phrase that occurs a >= `least` times within pieces is a candidate; its score is the lowest of
    floor(factor * a / (l + r)) over its cuts in two parts that occur l and r times.  Candidates inside a
    longer one that occurs at least `share` percent as often go; a word more on either side is all that
    needs a look, as whatever lies between two candidates is one that occurs no less than the longer.  n
    counts all words of the language.

    Passes over the texts, one per length: the words, then the stripes of each length of prefix.  Only grams
    whose prefix and rest are frequent are counted, so nothing that counts is lost.  From a stripe come the
    longer grams, the prefix's own count, and the largest count of a longer gram to its right.

    Defined cases: null and empty texts have no words, a null language is `und`, repeated rows count as
    often as they come, other columns do not matter; no candidates give no rows.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang")
    rows = docs.select(lang, F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    counts = staged(word_counts(rows).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    grams, table = write_table(_with_hashes(counts.where("word IS NOT NULL")))
    none = F.array().cast("array<bigint>")
    ids = [F.lit(None).cast("long").alias(c) for c in ("prefix", "next", "suffix")]
    level = grams.select("id", "lang", *ids, "n", F.col("word").alias("last"), F.col("word").alias("phrase"), none.alias("firsts"), none.alias("rests"))
    tokens = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    tables, candidates = [table], []
    while len(table) and len(tables) < words:
        found = staged(stripes(rows, tables, least, tokens), "stripes")
        entries = found.select("prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
        grams, table = write_table(entries.select(F.col("prefix").alias("a"), F.col("e.next").alias("b"), F.col("e.n").alias("n")))
        longer = staged(_longer(found, grams, level, None if len(tables) == 1 else level), "level")
        if len(tables) > 1:
            right = found.select(F.col("prefix").alias("id"), F.array_max("n").alias("n"))
            best = right.unionByName(longer.select(F.col("suffix").alias("id"), "n")).groupBy("id").agg(F.max("n").alias("best"))
            candidates[-1] = level.join(best, "id", "left")
        level = longer
        candidates.append(level.withColumn("best", F.lit(None).cast("long")))
        tables.append(table)
    if not candidates:
        return rows.sparkSession.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    every = candidates[0]
    for c in candidates[1:]:
        every = every.unionByName(c)
    wide = "CAST({} AS DECIMAL(20,0)) * {}"
    inside = F.expr(f"coalesce({wide.format('best', 100)} >= {wide.format('n', share)}, false)")
    scored = every.where(~inside).select("lang", "phrase", F.col("n").alias("a"), _lowest_cut(factor).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    totals = counts.where("word IS NULL").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
