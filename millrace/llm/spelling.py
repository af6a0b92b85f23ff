"""Spelling variants: words one edit apart, found through an index of variable-length grams."""

from __future__ import annotations

import zlib
from collections import Counter
from heapq import nsmallest
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of
from millrace.session import staged

#: A run of letters: ASCII and U+00C0 to U+00FF.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FRONT, BACK = "^", "$"  # stand before and behind every word; no word holds them
SHORTEST, LONGEST = 2, 5  # grams; LONGEST may be at most the shortest word's length, see `decompose`
DICTIONARY = 50_000  # at most so many frequent grams of each length
RARE = 64  # a gram in this many words or fewer is never made longer
HELD = 500_000  # different grams a task counts before it hands them on
LIST = 128  # words of one list that are compared with each other; longer lists are cut
CELLS = 1 << 20  # characters compared at a time


def occurrences(docs: DataFrame, id_col: str, text_col: str, every: int) -> DataFrame:
    """(word): every run of letters, in ASCII lower case; the checksum of id and run says which lose a letter."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name")
    low = F.translate(F.col(text_col), UPPER, LOWER)
    runs = docs.select(name, F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "name", "run").cast("binary"))
    runs = runs.select("run", F.when(h % every == 0, (h % F.length("run")).cast("int")).alias("cut"))
    shorter = F.concat(F.substring("run", F.lit(1), F.col("cut")), F.substring("run", F.col("cut") + 2, F.length("run")))
    return runs.select(F.when(F.col("cut").isNull(), F.col("run")).otherwise(shorter).alias("word"))


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): grams of SHORTEST to LONGEST letters, pads included, and in how many places of `word` they stand."""

    def run(batches):
        held: Counter[str] = Counter()
        for b in batches:
            for w in b["word"].to_pylist():
                w = f"{FRONT}{w}{BACK}"
                for q in range(SHORTEST, LONGEST + 1):
                    held.update([w[p : p + q] for p in range(len(w) - q + 1)])
                if len(held) > HELD:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    return words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The dictionary: grams in so many places that they are worth making longer.

    What counts as many grows with the words, so there are never more than DICTIONARY grams of a length.
    """
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    least = max(RARE, places // DICTIONARY)
    return {r["gram"]: r["n"] for r in gram_counts(words).where(F.col("n") > least).collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the variable gram at every place of a padded word.

    A gram starts with SHORTEST letters and grows while it is frequent, up to LONGEST.  So what it is
    depends on its own letters alone: an edit changes the grams that hold its place and no others.  The
    first and the last gram never share a letter, as LONGEST is at most the length of a word without pads;
    so some gram outlives any one edit.
    """
    n, out = len(word), []
    for p in range(n - SHORTEST + 1):
        e = p + SHORTEST
        while e < n and e - p < LONGEST and word[p:e] in frequent:
            e += 1
        out.append((p, e))
    return out


def most_affected(grams: list[tuple[int, int]], n: int) -> int:
    """How many grams one edit can hit: an inserted letter hits no more than a changed one beside it."""
    step = [0] * (n + 1)
    for p, e in grams:
        step[p] += 1
        step[e] -= 1
    return max(list(accumulate(step))[1 : n - 1])


def list_places(word: str, frequent: dict[str, int]) -> set[tuple[int, int]]:
    """(letters kept in front, letters kept behind): the lists a word has to be in.

    Two words one edit apart share all grams but the affected ones.  With the grams of each in one order,
    rarest first and equal ones by place, the first shared one is among the first 1 + most_affected of both,
    so the longest lists need not be merged.  A shared gram lies left of the edit, and then all letters up to its end are the
    same, or right of it, and then all from its start on are: its list holds only words equal on that side.
    """
    w = f"{FRONT}{word}{BACK}"
    grams = decompose(w, frequent)
    order = [(frequent.get(w[p:e], 0), zlib.crc32(w[p:e].encode()), w[p:e], p, e) for p, e in grams]
    out = set()
    for *_, p, e in nsmallest(1 + most_affected(grams, len(w)), order):
        if e < len(w):
            out.add((e - 1, 0))
        if p > 0:
            out.add((0, len(word) - p + 1))
    return out


def list_entries(words: DataFrame, frequent: dict[str, int], shortest: int) -> DataFrame:
    """(id, word, size, front, back): a word's places in lists for words of `size` letters and one more."""
    known = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        for b in pieces_of(batches, "word", CELLS):
            at, size, front, back = [], [], [], []
            for i, w in enumerate(b["word"].to_pylist()):
                for f, t in list_places(w, known.value):
                    for m in (len(w), len(w) - 1):
                        if m >= max(shortest, f + t):
                            at.append(i)
                            size.append(m)
                            front.append(f)
                            back.append(t)
            ints = [pa.array(x, pa.int32()) for x in (size, front, back)]
            rows = pa.array(at, pa.int64())
            yield pa.record_batch([b["id"].take(rows), b["word"].take(rows), *ints], names=["id", "word", "size", "front", "back"])

    return words.select("id", "word").mapInArrow(run, "id long, word string, size int, front int, back int")


def _key() -> Column:
    """Words of a list agree in size and in the letters kept; a chance clash only lengthens a list."""
    kept = F.concat_ws("|", F.substring("word", F.lit(1), F.col("front")), F.expr("right(word, back)"))
    return F.xxhash64("size", "front", "back", kept)


def cut_long_lists(entries: DataFrame) -> DataFrame:
    """`entries` with `key`, no list longer than LIST unless one letter at most is free in it.

    Of the letters that are not yet known to agree, one edit leaves the first or the last half as it is; so a
    long list becomes two sets of lists that agree in more.  Twice the rows a round, and as many rounds as a
    word can be halved.
    """
    done, left = [], entries.withColumn("key", _key())
    while True:
        left = staged(left, "lists")
        free = F.col("size") - F.col("front") - F.col("back")
        long = left.where(free > 1).groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > LIST).select("key")
        long = staged(long, "long")
        if long.isEmpty():
            return _union([*done, left])
        done.append(left.join(long, "key", "left_anti").select(left.columns))
        hot, half = left.join(long, "key", "left_semi"), (free / 2).cast("int")
        sides = F.array(
            F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back")),
            F.struct(F.col("front").alias("front"), (F.col("back") + free - half).alias("back")),
        )
        halves = hot.select("id", "word", "size", F.explode(sides).alias("side")).select("id", "word", "size", "side.*")
        left = halves.withColumn("key", _key()).select(left.columns).distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def letters(words: pa.Array, width: int) -> np.ndarray:
    """Code points of words, one row each, zeros behind; letters of RUN fit a byte."""
    line = "".join([w.ljust(width, "\0") for w in words.to_pylist()])
    return np.frombuffer(line.encode("latin-1"), np.uint8).reshape(-1, width)


def one_edit(short: np.ndarray, other: np.ndarray, size: int, longer: np.ndarray) -> np.ndarray:
    """For rows of code points: are they one edit apart?  `short` has `size` letters, `other` as many or, where `longer`, one more."""
    differ = short[:, :size] != other[:, :size]
    out = differ.sum(1) == 1
    if longer.any():
        front = np.where(differ[longer].any(1), differ[longer].argmax(1), size)
        tail = (short[longer, :size] != other[longer, 1 : size + 1])[:, ::-1]
        out[longer] = front + np.where(tail.any(1), tail.argmax(1), size) >= size
    return out


def _near_in_lists(batches):
    """Compare the words of each list; rows come sorted by size and key, lists may go on in the next batch."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        rest = pa.concat_tables([rest, t]) if rest is not None else t
        if rest.num_rows >= 1 << 14:
            key = rest["key"].to_numpy()
            done = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])  # the last list may go on
            if done:
                yield from _near(rest.slice(0, done))
                rest = rest.slice(done)
    if rest is not None:
        yield from _near(rest)


def _near(table: pa.Table):
    table = table.combine_chunks()
    sizes, key, ids = (table[c].to_numpy() for c in ("size", "key", "id"))
    for lo, hi in _runs(sizes):
        size = int(sizes[lo])
        rows = max(LIST, CELLS // (size + 1))
        starts = lo + np.flatnonzero(np.r_[True, key[lo + 1 : hi] != key[lo : hi - 1]])
        at = 0
        while at < len(starts):  # whole lists of about so many rows
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + rows)))
            a, z = int(starts[at]), int(starts[to]) if to < len(starts) else hi
            yield from _pairs(table["word"].chunk(0).slice(a, z - a), key[a:z], ids[a:z], size)
            at = to


def _runs(x: np.ndarray):
    cut = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, np.int64)
    return zip(cut.tolist(), [*cut[1:].tolist(), len(x)])


def _pairs(words: pa.Array, key: np.ndarray, ids: np.ndarray, size: int):
    code = letters(words, size + 1)
    longer = code[:, size] != 0
    block = max(1, CELLS // (size + 1))
    gap, alive = 1, np.arange(len(key))
    while len(alive):
        alive = alive[alive + gap < len(key)]
        alive = alive[key[alive] == key[alive + gap]]  # lists lie together, so no pair further on is of one list
        for part in range(0, len(alive), block):
            i = alive[part : part + block]
            j = i + gap
            i, j = np.where(longer[i], j, i), np.where(longer[i], i, j)
            ok = ~longer[i]
            i, j = i[ok], j[ok]
            hit = one_edit(code[i], code[j], size, longer[j])
            if hit.any():
                yield pa.record_batch([ids[i[hit]], ids[j[hit]]], names=["a", "b"])
        gap += 1


def near_words(words: DataFrame, shortest: int) -> DataFrame:
    """(a, b): ids of all pairs of different words one inserted, deleted or replaced code point apart, once each way.

    `words` has id and word, each word once and none shorter than `shortest`.
    """
    if shortest < LONGEST:
        raise ValueError(f"words need {LONGEST} letters or more")
    entries = cut_long_lists(list_entries(words, frequent_grams(words), shortest))
    dealt = entries.select("id", "word", "size", "key").repartition("key").sortWithinPartitions("size", "key", "id")
    found = dealt.mapInArrow(_near_in_lists, "a long, b long").distinct()
    return found.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): where the chain of forms that starts at `id` ends; chains halve every round."""
    chain = staged(forms.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root"), F.lit(True).alias("moved")), "chain")
    while not chain.where("moved").isEmpty():
        further = chain.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = chain.select("id", "root").join(further, "root", "left")
        chain = staged(step.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "chain")
    return chain.select("id", "root")


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, shortest: int = 5, least: int = 3, factor: int = 2
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of at least `shortest` code points seen `least` times.

    Words are runs of letters in ASCII lower case; where `every` divides the crc32 of `<id>:<run>`, the run
    loses one letter first.  form is the word one edit away with the largest count (ties: the first in code
    point order), if that is at least `factor` times the word's own; root is the end of the chain of forms.

    Defined cases: null and empty texts have no words; a null id reads as an empty one; repeated rows count
    as often as they come; other columns do not matter; very long words are words; no words give no rows.
    """
    words = occurrences(docs, id_col, text_col, every).where(F.length("word") >= shortest)
    words = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    words = staged(words.withColumn("id", F.monotonically_increasing_id()), "words")
    other = words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form", "form_n", F.col("b").alias("form_id"))).alias("best")
    per_word = near_words(words, shortest).join(other, "b").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), best)
    forms = words.join(per_word, "id", "left")
    taken = F.col("best.form_n") >= factor * F.col("n")
    picked = [F.when(taken, F.col(f"best.{c}")).alias(c) for c in ("form", "form_n", "form_id")]
    forms = staged(forms.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *picked), "forms")
    names = _roots(forms).join(forms.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    out = forms.join(names, "id", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
