"""Toxicity of texts: noisy-channel deobfuscation, then a classifier on the restored words."""

from __future__ import annotations

import math
import re
import unicodedata
from array import array
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import local_roots
from millrace.session import staged

# The channel: what a sign may stand for, and what each kind of disguise costs (negative log probability).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "§": "s", "*": "aeiou", "#": "aeiou",
}
SWAP, DROP, SHRINK, LITERAL = 1.0, 1.0, 1.0, 4.0

ORDER = 4  # of the character model: 29 symbols, so at most 29 ** 4 different grams
START, END, OTHER = "^", "$", "?"
PREFIXES = (4, 5, 6)
REMEMBERED = 200_000  # words a worker keeps the result of; beyond that it starts anew
HELD_WORDS = 60_000  # words a task holds with their counts or features before it hands them on

_EDGE = ".,;:?\"'()[]{}<>-_…«»“”„‘’`~=/\\&%^"
_FENCE = re.compile(r"^([^\w\s])\1\1+|([^\w\s])\2\2+$")  # three or more of one sign are no letter
_TWICE = re.compile(r"(.)\1")
_REPEATED = re.compile(r"(.)\1+")
_PIECES = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=4096)
def fold(ch: str) -> str:
    """A letter without its accent; any letter beyond a to z is one symbol."""
    base = unicodedata.normalize("NFD", ch)[0]
    return base if "a" <= base <= "z" else OTHER


class _Codes(dict):
    """Code point -> one of the symbols as a character; filled as letters turn up."""

    def __missing__(self, point: int) -> str:
        self[point] = chr(_CODE[fold(chr(point))])
        return self[point]


_CODE = {END: 0, START: 1, **{c: i + 2 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}}
_CODE[OTHER] = 28
_BASE = 29
_CODES = _Codes({ord(END): chr(0), ord(START): chr(1)})
_STATES = _BASE ** (ORDER - 1)
_BEGIN = sum(_CODE[START] * _BASE**i for i in range(ORDER - 1))  # the state before a word


class CharModel:
    """Interpolated character model of words, with absolute discounting: one cost per state and symbol.

    A state is the last ORDER - 1 symbols as a number in base 29, so the whole model is a table of 29 ** 4
    single-precision numbers, 2.8 MB whatever it was counted from.
    """

    def __init__(self, grams: np.ndarray):
        p = np.full(_BASE, 1 / (_BASE - 1))
        for k in range(1, ORDER + 1):
            n = grams.reshape(-1, _BASE**k).sum(0).reshape(-1, _BASE).astype(float)  # by context of k - 1 symbols
            total, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
            lower = np.broadcast_to(p.reshape(1, -1, _BASE), (_BASE if k > 1 else 1, max(1, _BASE ** (k - 2)), _BASE)).reshape(-1, _BASE)
            p = np.where(total > 0, (np.maximum(n - 0.75, 0) + 0.75 * kinds * lower) / np.maximum(total, 1), lower).ravel()
        self.costs = array("f", (-np.log(p)).astype(np.float32).tobytes())


def word_grams(words: dict[str, int]) -> np.ndarray:
    """How often each gram occurs in plain words with their counts, by the gram's number in base 29."""
    total = np.zeros(_BASE**ORDER, np.int64)
    if not words:
        return total
    pad = START * (ORDER - 1)
    line = "".join([pad + w + END for w in words])
    codes = np.frombuffer(line.translate(_CODES).encode("ascii"), np.uint8).astype(np.int32)
    size = np.array([len(w) + ORDER for w in words])
    weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), size)
    number = sum(codes[i : len(codes) - ORDER + 1 + i] * _BASE ** (ORDER - 1 - i) for i in range(ORDER))
    inside = np.ones(len(codes), bool)  # a gram that starts in a word's last places would reach into the next
    ends = np.cumsum(size)
    for i in range(1, ORDER):
        inside[ends - i] = False
    inside = inside[: len(number)]
    return np.bincount(number[inside], weight[: len(number)][inside], len(total)).astype(np.int64)


def lattice(text: str) -> list[list[tuple[str, float]]]:
    """Readings of each stretch of a disguised word: (letters, " " for a word boundary or a plain sign; cost)."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(text):
        ch, j = text[i], i + 1
        while j < len(text) and text[j] == ch:
            j += 1
        run = j - i
        if ch.isalpha():
            out.append([(ch, 0.0)] if run == 1 else [(ch, SHRINK), (ch * 2, 0.0 if run == 2 else SHRINK)])
        elif ch in LEET:
            kept = (f" {text[i:j]} ", LITERAL * run)
            swapped = [(x * n, SWAP * n) for x in LEET[ch] for n in ({1, run} if run < 3 else {1, 2})]
            out.append([kept, *swapped, *([("", DROP)] if ch in WILD else [])])
        else:
            out.append([("", DROP), (" ", 0.0)])
        i = j
    return out


def restore(text: str, model: CharModel) -> list[str]:
    """The words of the cheapest path through the lattice under channel and character model (Viterbi)."""
    costs, code = model.costs, _CODES
    paths: dict[int, tuple] = {_BEGIN: (0.0, None)}  # by the last symbols: cost, and the readings so far, last one first
    for readings in lattice(text) + [[(" ", 0.0)]]:
        after: dict[int, tuple] = {}
        for state, (cost, done) in paths.items():
            for reading, extra in readings:
                s, c = state, cost + extra
                for ch in reading:
                    if ch.isalpha():
                        at = s * _BASE + ord(code[ord(ch)])
                        c += costs[at]
                        s = at % _STATES
                    elif s != _BEGIN:
                        c += costs[s * _BASE]  # END
                        s = _BEGIN
                if s not in after or c < after[s][0]:
                    after[s] = c, (done, reading)
        paths = after
    done, out = paths[_BEGIN][1], []  # every path has ended with the boundary
    while done is not None:
        done, reading = done
        out.append(reading)
    return _PIECES.findall("".join(reversed(out)))


def features(word: str):
    yield word
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n] + "~"


#: Signs that stand for several letters or may be dropped as well: what they are is only known by decoding.
WILD = "!*#|+"
#: Letters that one sign may stand for alike, as one; repeats as one; whatever else is no letter as none.
_ALIKE = str.maketrans({"l": "i", **{k: v[0].replace("l", "i") for k, v in LEET.items() if k not in WILD}})


def squeezed(word: str) -> str:
    """A word with each repeated letter once."""
    return _REPEATED.sub(r"\1", word)


def outline(word: str) -> str:
    """A form that a word shares with all its disguises, but for wild signs."""
    word = word.translate(_ALIKE)
    return squeezed(word if word.isalpha() else "".join(filter(str.isalpha, word)))


class Restorer:
    """Words of a text as they are meant.

    With weights at hand, only chunks are decoded in which some weighted feature can turn up at all: its
    outline must be inside the chunk's, or the chunk hold a wild sign.  The others cannot change a score: a
    path through the lattice keeps the outline of each of its words, as all else than a wild sign is either
    the letter of its outline, dropped where the outline drops it, or a boundary.  A chunk of letters alone
    has no boundary inside, so it is one word, and a feature, which is a word or its first letters, can only
    stand at its front.  Its letters stay, some repeats aside, so it is only decoded if, repeats aside, it is a
    word or begins with first letters that have a weight and are not among the features it has as it stands.
    """

    def __init__(self, model: CharModel, weights: dict[str, float] | None = None):
        self.model, self.finder = model, None
        if weights is not None:
            self.finder = ahocorasick.Automaton()
            self.outlines = {outline(f.rstrip("~")) for f in weights} - {""}
            self.words: dict[str, set[str]] = {}
            self.fronts: dict[str, set[str]] = {}
            for f in weights:
                (self.fronts if f.endswith("~") else self.words).setdefault(squeezed(f.rstrip("~")), set()).add(f)
            self.lengths = sorted({len(f) for f in self.fronts})
            for f in self.outlines:
                self.finder.add_word(f, 1)
            self.finder.make_automaton()

    def hopeful(self, chunk: str) -> bool:
        if self.finder is None or any(c in chunk for c in WILD):
            return True
        return len(self.finder) > 0 and next(self.finder.iter(outline(chunk)), None) is not None

    def hopeful_letters(self, chunk: str) -> bool:
        if self.finder is None:
            return True
        line, own = squeezed(chunk), set(features(chunk))
        if not own.issuperset(self.words.get(line, ())):
            return True
        return any(not own.issuperset(self.fronts.get(line[:n], ())) for n in self.lengths)

    def readings(self, word: str) -> list[str]:
        """Plain words that a chunk without white space may hold, restored ones included."""
        core = word.strip(_EDGE).rstrip("!")
        if core.isalpha():
            if _TWICE.search(core) and self.hopeful_letters(core):
                return [core, *restore(core, self.model)]
            return [core]
        core = _FENCE.sub("", core).strip(_EDGE).rstrip("!")
        plain = _PIECES.findall(core)
        if not plain:
            return []
        if core.isalpha() and not _TWICE.search(core) or not self.hopeful(core):
            return plain
        return [*plain, *restore(core, self.model)]

    def spaced(self, words: list[str]) -> list[str]:
        """Words that are spelt out in single signs, three or more in a row."""
        one = np.fromiter(map(len, words), np.int64, len(words)) == 1
        if one.sum() < 3:
            return []
        edge = np.flatnonzero(np.diff(np.r_[False, one, False].astype(np.int8)))
        out = []
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= 3 and self.hopeful("".join(words[a:b])):
                out += restore(" ".join(words[a:b]), self.model)
        return out


class Scorer:
    """Evidence of a text: the weights of the two strongest features of its restored words."""

    def __init__(self, model: CharModel, weights: dict[str, float], remembered: int = REMEMBERED):
        self.restorer, self.remembered = Restorer(model, weights), remembered
        # Features are numbered from the strongest on, so the two strongest are the two smallest numbers.
        names = sorted(weights, key=lambda f: (-weights[f], f))
        self.strengths = [weights[f] for f in names]
        self.whole = {f: i for i, f in enumerate(names) if not f.endswith("~")}
        self.starts = [(n, {f[:n]: i for i, f in enumerate(names) if f.endswith("~") and len(f) == n + 1}) for n in PREFIXES]
        self.memo: dict[str, tuple[int, ...]] = {}

    def best(self, words: list[str]) -> tuple[int, ...]:
        """The numbers of the two strongest features of some words."""
        found = set()
        for w in words:
            if w in self.whole:
                found.add(self.whole[w])
            size = len(w)
            for n, starts in self.starts:
                if size <= n:
                    break
                if (f := starts.get(w[:n])) is not None:
                    found.add(f)
        return tuple(sorted(found)[:2]) if found else ()

    def evidence(self, text: str | None) -> tuple[float, float]:
        words = text.lower().split() if text else []
        if len(self.memo) > self.remembered:
            self.memo.clear()
        memo, kinds = self.memo, set(words)
        for w in kinds.difference(memo):
            memo[w] = self.best(self.restorer.readings(w))
        found = set(chain.from_iterable(map(memo.__getitem__, kinds)))
        found.update(self.best(self.restorer.spaced(words)))
        top = [self.strengths[i] for i in sorted(found)[:2]]
        return tuple(top + [0.0] * (2 - len(top)))


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """Trained on every word of every text; the alphabet bounds what comes to the driver."""

    def count(batches):
        total, words = 0, Counter()
        for b in batches:
            for t in b["text"].to_pylist():
                words.update((t or "").lower().split())
            if len(words) > HELD_WORDS:
                total, words = total + word_grams(_plain_words(words)), Counter()
        total = total + word_grams(_plain_words(words))
        grams = np.flatnonzero(total)
        yield pa.record_batch([pa.array(grams), pa.array(total[grams])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "gram long, n long")
    grams = np.zeros(_BASE**ORDER, np.int64)
    for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        grams[r["gram"]] = r["n"]
    return CharModel(grams)


def _plain_words(words: Counter) -> dict[str, int]:
    out: dict[str, int] = {}
    for w, n in words.items():
        if not w.isalpha():
            w = w.strip(_EDGE).rstrip("!")
            if not w.isalpha():
                continue
        out[w] = out.get(w, 0) + n
    return out


@dataclass
class Model:
    chars: CharModel
    weights: dict[str, float]
    coefficients: np.ndarray  # of a constant and the two weights of evidence

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.coefficients[0] + evidence @ self.coefficients[1:])))


def fold_of(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 5, held_out: int = 0, most_toxic: int = 4000, most_clean: int = 12000, least_docs: int = 4, least_weight: float = 0.0) -> Model:
    """Character model from all texts, word weights and calibration from labelled rows outside the held-out fold.

    The classifier is fitted on at most `most_toxic` and `most_clean` labelled documents, those whose ids hash
    lowest; that bounds all that is collected here.  Of near copies among them one is kept, so that a
    much copied text counts once.  A feature is a restored word or its first 4 to 6 letters; its weight
    is the lower end of its log odds between toxic and clean documents, so that a rare word needs
    several documents before it counts; weights of `least_weight` or less are dropped.  A logistic fit over the two strongest features of a document
    gives the score; it sees each half of the sample through weights learnt on the other half.
    Labels that are null are left out, an id with several is toxic if any says so; null ids have none.
    Without labels of both kinds every text gets one score, the share of toxic labels; without any, 1/3.
    """
    chars = char_model(docs, text_col)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isNotNull() & (fold_of(F.col("id"), folds) != held_out)
    )
    marked = staged(marked.groupBy("id").agg(F.max("toxic").alias("toxic")), "labels")
    picked = [
        marked.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in ((1, most_toxic), (0, most_clean))
    ]
    # At most most_toxic + most_clean rows.
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
    # An id that repeats is one document here, with the least of its texts.
    rows = rows.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = staged(rows.repartition(tasks).mapInArrow(_signed, SIGNED), "signed")
    sample = staged(signed.join(F.broadcast(_one_of_near_copies(signed)), "id", "left_semi"), "sample")
    totals = {(r["toxic"], r["half"]): r["n"] for r in sample.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    size = {(y, h): totals.get((y, h), 0) for y in (0, 1) for h in (0, 1)}
    toxic, clean = size[1, 0] + size[1, 1], size[0, 0] + size[0, 1]
    if not toxic or not clean:
        return Model(chars, {}, np.array([math.log((toxic + 1) / (clean + 2)), 0.0, 0.0]))

    shared = sample.sparkSession.sparkContext.broadcast(chars)
    seen = _document_counts(sample.where("toxic = 1"), shared, None).where(F.expr(f"n0 + n1 >= {least_docs}"))
    seen = {r["feature"]: (r["n0"], r["n1"]) for r in seen.collect()}
    wanted = sample.sparkSession.sparkContext.broadcast(set(seen))
    other = _document_counts(sample.where("toxic = 0"), shared, wanted).collect()
    other = {r["feature"]: (r["n0"], r["n1"]) for r in other}

    def weights(halves: tuple[int, ...]) -> dict[str, float]:
        t, c = (sum(size[y, h] for h in halves) for y in (1, 0))
        out = {}
        for f, counts in seen.items():
            a, b = (sum(x[h] for h in halves) for x in (counts, other.get(f, (0, 0))))
            low = math.log((a + 0.5) / (t + 1)) - math.log((b + 0.5) / (c + 1)) - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if a >= least_docs and low > least_weight:
                out[f] = low
        return out

    crossed = [
        r
        for half in (0, 1)
        for r in _evidence(
            sample.where(F.col("half") == half).select("toxic", "text"), "toxic", "int", Model(chars, weights((1 - half,)), np.zeros(3))
        ).collect()
    ]
    x = np.array([[1.0, r["strongest"], r["second"]] for r in crossed])
    return Model(chars, weights((0, 1)), _logistic(x, np.array([r["toxic"] for r in crossed], float)))


SIGNED = "id long, toxic int, half int, signature array<long>, text string"
BANDS, ROWS = 6, 4  # smallest shingle hashes, four to a band: near copies agree in some band, other texts hardly ever


def _signed(batches):
    """Rows with a signature of their word triples, from their smallest hashes under a few functions."""
    rng = np.random.default_rng(7)
    turns = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    for b in batches:
        signatures = []
        for t in b["text"].to_pylist():
            words = (t or "").lower().split()
            triples = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
            h = np.array([xxhash.xxh64_intdigest(x) for x in triples], np.uint64)
            low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
            for at in range(0, len(h), 1 << 14):
                x = h[at : at + (1 << 14), None] * turns
                low = np.minimum(low, (x ^ (x >> np.uint64(29))).min(0))
            signatures.append([xxhash.xxh64_intdigest(band.tobytes()) >> 1 for band in low.reshape(BANDS, ROWS)])
        half = pa.array([xxhash.xxh64_intdigest(str(i)) % 2 for i in b["id"].to_pylist()], pa.int32())
        yield pa.record_batch(
            [b["id"].cast(pa.int64()), b["toxic"], half, pa.array(signatures, pa.list_(pa.int64())), b["text"]],
            names=[c.split()[0] for c in SIGNED.split(", ")],
        )


def _one_of_near_copies(signed: DataFrame) -> DataFrame:
    """(id) of one row of each group that shares signature hashes; the sample is bounded, so this is local."""
    rows = sorted((r["id"], *r["signature"]) for r in signed.select("id", "signature").collect())
    first: dict[tuple[int, int], int] = {}
    links = [(i, first.setdefault((k, h), i)) for i, r in enumerate(rows) for k, h in enumerate(r[1:])]
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    root = local_roots(len(rows), a, b)
    kept = [rows[i][:1] for i in np.flatnonzero(root == np.arange(len(rows)))]
    return signed.sparkSession.createDataFrame(kept, "id long")


def _document_counts(rows: DataFrame, chars, wanted) -> DataFrame:
    """(feature, n0, n1): in how many documents of either half each feature occurs; only the wanted ones, if given."""

    def count(batches):
        restorer, memo = Restorer(chars.value), {}
        for b in batches:
            n: tuple[Counter, Counter] = Counter(), Counter()
            for half, t in zip(b["half"].to_pylist(), b["text"].to_pylist()):
                words = (t or "").lower().split()
                found: set[str] = set()
                for w in set(words):
                    if w not in memo:
                        got = {f for r in restorer.readings(w) for f in features(r)}
                        memo[w] = got if wanted is None else got & wanted.value
                    found |= memo[w]
                spelt = {f for w in restorer.spaced(words) for f in features(w)}
                n[half].update(found | (spelt if wanted is None else spelt & wanted.value))
                if len(memo) > HELD_WORDS:
                    memo.clear()
            names = list(n[0].keys() | n[1].keys())
            columns = [pa.array(names, pa.string()), *(pa.array([c[f] for f in names], pa.int64()) for c in n)]
            yield pa.record_batch(columns, names=["feature", "n0", "n1"])

    found = rows.select("half", "text").mapInArrow(count, "feature string, n0 long, n1 long")
    return found.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method; the ridge keeps separable classes finite."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _evidence(rows: DataFrame, keep: str, kind: str, model: Model, remembered: int = REMEMBERED) -> DataFrame:
    """(keep, strongest, second, score) for rows of (keep, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value.chars, shared.value.weights, remembered)
        for b in batches:
            x = np.array([scorer.evidence(t.as_py()) for t in b["text"]], float).reshape(-1, 2)
            yield pa.record_batch(
                [b[keep], pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(shared.value.score(x))],
                names=[keep, "strongest", "second", "score"],
            )

    return rows.select(keep, "text").mapInArrow(run, f"`{keep}` {kind}, strongest double, second double, score double")


def scored(docs: DataFrame, model: Model, text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """(row, score): every input row as a struct, whatever its columns, and its score from 0 to 1.

    Only the text is looked at, whole.  Null and empty texts have no evidence and get the lowest score;
    repeated rows get the same score each.  `remembered` words are kept with their result: more of them take
    memory of the worker and save time.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return _evidence(rows, "row", rows.schema["row"].dataType.simpleString(), model, remembered).select("row", "score")
