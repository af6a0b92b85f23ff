"""Language of texts: rank-order profiles of character n-grams, compared by out-of-place distance."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of

GRAM = 3  # letters of the longest gram; three code points of 21 bits fit a long
POINT = 21
PROFILE = 300  # grams of a profile
LANGUAGES = 1000  # that a model may hold; more raise
CHUNK = 2 << 20  # bytes of text counted at a time
HELD = 1 << 20  # rows of counts a task holds before it hands them on
SPACE = 0x20
UNKNOWN = "und"

_KIND: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """For every code point: 2 a letter, 1 a mark that goes with one, 0 anything else."""
    if not _KIND:
        of = {"L": 2, "M": 1}
        _KIND.append(np.array([of.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8))
    return _KIND[0]


def _line(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, text of each, which texts hold a letter): lower case, whatever is no letter as one space.

    A space stands before the first word and behind every word, also behind the last of a text.
    """
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer((" " + "".join([t + " " for t in low])).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) + 1 for t in low], np.int64)
    owner = np.concatenate([[0], np.repeat(np.arange(len(low)), size)])
    kind = kinds()[points]
    lettered = np.bincount(owner[kind == 2], minlength=len(low)) > 0
    inside = kind > 0
    keep = inside | np.r_[True, inside[:-1]]
    return np.where(inside, points, SPACE)[keep], owner[keep], lettered


def counted(texts: list[str | None], group: np.ndarray):
    """Yields (group, gram, count, texts with letters) for the grams of 1 to GRAM letters; a word's ends count as a space.

    Rows come in order of group and gram.  A gram is its code points, 21 bits each, the first one highest;
    so grams are in code point order.  Inside, points are numbered by what turns up, so that group and gram
    share one word; where they do not fit, the texts are taken in halves.
    """
    points, owner, lettered = _line(texts)
    present = np.flatnonzero(np.bincount(points, minlength=SPACE + 1))
    bits, least = len(present).bit_length(), int(group.min())
    if bits * GRAM + int(group.max(initial=least) - least).bit_length() > 63 and len(texts) > 1:
        half = len(texts) // 2
        yield from counted(texts[:half], group[:half])
        yield from counted(texts[half:], group[half:])
        return
    number = np.zeros(int(present[-1]) + 1, np.int64)
    number[present] = np.arange(1, len(present) + 1)
    code, base = number[points], number[SPACE]
    of = (group[owner] - least).astype(np.int64) << (bits * GRAM)
    letter = code != base
    one = (of | code << (2 * bits))[letter]
    two = of[1:] | code[:-1] << (2 * bits) | code[1:] << bits
    three = (of[1:-1] | code[:-2] << (2 * bits) | code[1:-1] << bits | code[2:])[letter[1:-1]]
    keys = np.sort(np.concatenate([one, two[: len(two) * bool(len(one))], three]))
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    count = np.diff(np.r_[starts, len(keys)])
    keys = keys[starts]
    back, mask = np.concatenate([[0], present]), (1 << bits) - 1
    gram = back[(keys >> (2 * bits)) & mask] << (2 * POINT) | back[(keys >> bits) & mask] << POINT | back[keys & mask]
    yield (keys >> (bits * GRAM)) + least, gram, count, lettered


@dataclass
class Model:
    """Ranks of the grams of each language: rank[gram, language], -1 where the profile does not hold the gram."""

    languages: list[str]
    grams: np.ndarray
    rank: np.ndarray = field(repr=False)
    size: int

    def distances(self, group: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """[group, language]: sum over a text's `size` most frequent grams of how far out of place they are.

        A gram the language's profile lacks is `size` places away.  Ties of counts go to the smaller gram.
        """
        line = np.arange(len(gram), dtype=np.int64)
        low, width = int(count.max(initial=1)), max(1, len(gram)).bit_length()
        order = np.sort((group << (low.bit_length() + width)) | ((low - count) << width) | line) & ((1 << width) - 1)
        group = group[order]
        first = np.searchsorted(group, np.arange(n))
        place = line - first[group]
        top = place < self.size
        gram, place, group = gram[order][top], place[top], group[top]
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        out = np.zeros((n, len(self.languages)), np.int64)
        for k in range(len(self.languages)):
            rank = self.rank[at, k]
            away = np.where(known & (rank >= 0), np.abs(rank - place), self.size)
            out[:, k] = np.bincount(group, away, n).astype(np.int64)
        return out


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all texts of each language."""

    def run(batches):
        held, rows = [], 0
        for b in pieces_of(batches, "text", CHUNK):
            langs = b["lang"].dictionary_encode()
            name, index = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)
            for group, gram, count, _ in counted(b["text"].to_pylist(), index):
                held.append(pa.table({"lang": name.take(pa.array(group)), "gram": gram, "n": count}))
                rows += len(gram)
            if rows > HELD:
                held = [_summed(held)]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held.pop().to_batches()
                    rows = 0
        if held:
            yield from _summed(held).to_batches()

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(held: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(held).group_by(["lang", "gram"]).aggregate([("n", "sum")])
    return out.rename_columns(["lang", "gram", "n"]).cast(pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())]))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, languages: int = LANGUAGES) -> Model:
    """The profile of every language: its `size` most frequent grams in all texts, by rank; ties to the smaller gram.

    Defined cases: rows without text or language teach nothing, and a language whose texts have no letter
    has no profile.  More than `languages` languages raise, as the model goes to every worker.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = gram_counts(docs, text_col, lang_col).withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size)
    rows = ranked.select("lang", "gram", "rank").limit(size * languages + 1).toArrow()
    names = sorted(set(rows["lang"].to_pylist()), key=str.encode)
    if len(names) > languages or rows.num_rows > size * languages:
        raise ValueError(f"more than {languages} languages")
    grams, at = np.unique(rows["gram"].to_numpy(), return_inverse=True)
    rank = np.full((len(grams), len(names)), -1, np.int64)
    column = {name: k for k, name in enumerate(names)}
    rank[at, [column[x] for x in rows["lang"].to_pylist()]] = rows["rank"].to_numpy()
    return Model(names, grams, rank, size)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every text, whole: the language whose profile is nearest, ties to the first name.

    score is 1 - nearest / second nearest distance; with one language, 1 - distance / the largest possible.

    Defined cases: null, empty and letterless texts, and all texts where no language was learned, give
    `und` and 0; repeated rows come as often, a null id stays null, other columns do not matter.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in pieces_of(batches, "text", CHUNK):
            texts, at, names, scores = b["text"].to_pylist(), 0, [], []
            for group, gram, count, lettered in counted(texts, np.arange(len(b))):
                n = len(lettered)
                found, score = _nearest(shared.value, group - at, gram, count, lettered)
                names += found
                scores.append(score)
                at += n
            yield pa.record_batch([b["id"], pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=["id", "lang_pred", "score"])

    return rows.mapInArrow(run, "id long, lang_pred string, score double")


def _nearest(model: Model, group: np.ndarray, gram: np.ndarray, count: np.ndarray, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
    n = len(lettered)
    if not model.languages:
        return [UNKNOWN] * n, np.zeros(n)
    away = model.distances(group, gram, count, n)
    best = away.argmin(1)
    if len(model.languages) > 1:
        nearest, second = np.partition(away, 1, axis=1)[:, :2].T
    else:
        held = np.minimum(np.bincount(group, minlength=n), model.size)
        nearest, second = away[:, 0], held * model.size
    score = np.where(lettered & (second > 0), 1 - nearest / np.maximum(second, 1), 0.0)
    return [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)], score
