"""SentencePiece encoding and decoding by a batched Viterbi search in numpy."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of

SPACE = "▁"  # how the model files write a space
UNKNOWN_PENALTY = 10.0  # fixed value: below the lowest score, for a character that no piece holds
SIEVE_BITS = 20  # most substrings are no piece; their highest hash bits tell without a search
MEMO_BITS = 20  # answers about neighbouring pieces that are kept
BASE = 0x9E3779B97F4A7C15  # odd multiplier of the substring hash
CHUNK = 2 << 20  # bytes of text whose words are searched together
REMEMBERED, LETTERS_A_WORD = 120_000, 32  # words a worker keeps the ids of, and their letters on average; beyond that it starts anew
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # fixed values of the file format
UNIGRAM, BPE = 1, 2


class Pieces:
    """A model file's pieces, ready to be probed by substring hash.

    Two kinds of model are read.  In a unigram model the best segmentation has the highest sum of scores.
    In a BPE model the segmentation is what merging the best-scored neighbours again and again leads to;
    a sequence of pieces is that segmentation if and only if any two neighbours are the segmentation of
    their own two texts.  So both are a search over the same lattice: position by position, each holding its
    best last piece, which for BPE must also stand next to the piece before it (`_stands`).
    """

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(data)
        self.kind, spec = model.trainer_spec.model_type, model.normalizer_spec
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        if spec.precompiled_charsmap or model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("only models that take the text as it is")
        self.prefix, self.collapse = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.bytes = np.zeros(256, np.int64)
        self.fallback = model.trainer_spec.byte_fallback
        self.unknown, self.table = 0, []
        texts, ids, self.score = [], [], {}
        for i, p in enumerate(model.pieces):
            self.table.append(p.piece.replace(SPACE, " ").encode())
            if p.type in (NORMAL, USER):
                texts.append(p.piece)
                ids.append(i)
                self.score[p.piece] = p.score
            elif p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value], self.table[-1] = i, bytes([value])
            elif p.type == UNKNOWN:
                self.unknown, self.table[-1] = i, " ⁇ ".encode()
            else:
                self.table[-1] = b""
        self.texts, self.longest = texts, max(map(len, texts))
        self.lengths = np.array([len(t) for t in texts])
        self.points = np.zeros((len(texts), self.longest), np.uint32)
        for row, t in zip(self.points, texts):
            row[: len(t)] = [ord(c) for c in t]
        self.ids, self.scores = np.array(ids), np.array([self.score[t] for t in texts])
        self.lowest = float(min(self.scores.min(), 0.0)) - UNKNOWN_PENALTY
        self.power = np.multiply.accumulate(np.array([1] + [BASE] * self.longest, np.uint64))
        running = self._running(self.points)
        keys = running[np.arange(len(texts)), self.lengths]
        order = np.argsort(keys)
        self.keys, self.at = keys[order], order
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.maybe_first = np.zeros(1 << 16, bool)  # characters with which a piece may end, by their lower bits
        self.maybe_first[[ord(t[-1]) & 0xFFFF for t in texts]] = True
        self.maybe = np.zeros(1 << SIEVE_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - SIEVE_BITS)] = True
        # Whether two pieces may stand side by side, as far as it was asked; newer answers replace older ones.
        self.asked, self.answer = np.full(1 << MEMO_BITS, -1, np.int64), np.zeros(1 << MEMO_BITS, bool)
        self.touching = {t[i : i + 2] for t in texts for i in range(len(t) - 1)}
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.letters = [0, 0]  # in each
        self.remembered = REMEMBERED
        self.word = re.compile(self._word_pattern())

    def _word_pattern(self) -> str:
        """Stretches that no piece reaches across, so that each can be encoded on its own."""
        if any(SPACE in t.lstrip(SPACE) for t in self.texts):
            return r"(?s).+"
        inside = {c for t in self.texts if len(t) > 1 for c in t}
        alone = "".join(c for c in "\n\r\t" if c not in inside)
        return f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+"

    @staticmethod
    def _running(points: np.ndarray) -> np.ndarray:
        """Polynomial hash of every prefix of each row."""
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        for i in range(points.shape[1]):
            out[:, i + 1] = out[:, i] * np.uint64(BASE) + points[:, i].astype(np.uint64) + np.uint64(1)
        return out

    def _probe(self, points: np.ndarray, running: np.ndarray, start: int, end: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of `rows`, pieces) where a piece lies between two positions; running holds positions first."""
        n = end - start
        key = running[end, rows] - running[start, rows] * self.power[n]
        hit = np.flatnonzero(self.maybe[key >> np.uint64(64 - SIEVE_BITS)])
        key = key[hit]
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        same = self.keys[i] == key
        hit, piece = hit[same], self.at[i[same]]
        same = (self.lengths[piece] == n) & (self.points[piece, :n] == points[rows[hit], start:end]).all(1)
        return hit[same], piece[same]

    def search(self, words: list[str]) -> list[bytes]:
        """Ids of words of equal length, which advance together position by position."""
        length, count = len(words[0]), len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(count, length)
        running = np.ascontiguousarray(self._running(points).T)
        best = np.zeros((length + 1, count))
        last = np.full((length + 1, count), -1)
        step = np.ones((length + 1, count), np.int64)
        every = np.arange(count)
        for end in range(1, length + 1):
            if self.kind == UNIGRAM:  # a character without a piece, unless a better way is found
                best[end] = best[end - 1] + self.lowest
                for n in range(min(end, self.longest), 0, -1):
                    rows, piece = self._probe(points, running, end - n, end, every)
                    value = best[end - n, rows] + self.scores[piece]
                    better = (value > best[end, rows]) | ((n == 1) & (step[end, rows] == 1))
                    rows = rows[better]
                    best[end, rows], last[end, rows], step[end, rows] = value[better], piece[better], n
                continue
            open_ = every  # one piece at most may stand here, so a word that has it is done
            for n in range(1, min(end, self.longest) + 1):
                hit, piece = self._probe(points, running, end - n, end, open_)
                before = last[end - n, open_[hit]] if end > n else np.full(len(hit), -1)
                good = before < 0
                check = np.flatnonzero(~good)
                if len(check):
                    good[check] = self._all_stand(before[check], piece[check])
                hit, piece = hit[good], piece[good]
                last[end, open_[hit]], step[end, open_[hit]] = piece, n
                left = np.ones(len(open_), bool)
                left[hit] = False
                if n == 1:  # a character without a piece stands alone
                    left &= self.maybe_first[points[open_, end - 1] & 0xFFFF] | (points[open_, end - 1] > 0xFFFF)
                open_ = open_[left]
                if not len(open_):
                    break
        return self._walk_back(points, last, step)

    def _walk_back(self, points: np.ndarray, last: np.ndarray, step: np.ndarray) -> list[bytes]:
        """The pieces along the backpointers of every word, as ids."""
        length, count = points.shape[1], len(points)
        at, rows, found = np.full(count, length), np.arange(count), []
        while len(rows):
            piece = last[at[rows], rows]
            alone = ~points[rows, at[rows] - 1].astype(np.int64)
            found.append((rows, np.where(piece >= 0, piece, alone)))
            at[rows] -= step[at[rows], rows]
            rows = rows[at[rows] > 0]
        rows, piece = (np.concatenate(x[::-1]) for x in zip(*found))
        order = np.argsort(rows, kind="stable")
        rows, piece = rows[order], piece[order]
        ends = np.cumsum(np.bincount(rows, minlength=count)).tolist()
        raw = self.ids[np.maximum(piece, 0)].astype("<u4").tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
        for r in np.unique(rows[piece < 0]).tolist():
            out[r] = self._ids(piece[ends[r - 1] if r else 0 : ends[r]].tolist())
        return out

    def _all_stand(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left * len(self.texts) + right
        slot = (pair.astype(np.uint64) * np.uint64(BASE) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        new = self.asked[slot] != pair
        found = self.answer[slot]
        if new.any():
            keys, back = np.unique(pair[new], return_inverse=True)
            n = len(self.texts)
            answers = np.array([self._stands(self.texts[k // n], self.texts[k % n]) for k in keys.tolist()])
            found[new] = answers[back]
            self.asked[slot[new]], self.answer[slot[new]] = pair[new], found[new]
        return found

    def _stands(self, left: str, right: str) -> bool:
        """True if merging the characters of both texts ends in just these two pieces."""
        parts = list(left + right)
        while len(parts) > 1:
            scores = [self.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            top = max(scores)
            if top == -np.inf:
                break
            i = scores.index(top)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts == [left, right]

    def _ids(self, pieces: list[int]) -> bytes:
        out: list[int] = []
        for p in pieces:
            if p >= 0:
                out.append(int(self.ids[p]))
            elif self.fallback:
                out.extend(int(self.bytes[b]) for b in chr(~p).encode("utf-8", "replace"))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def normalized(self, text: str) -> str:
        if self.collapse:
            text = " ".join(w for w in text.split(" ") if w)
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", SPACE)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text.  New words are searched together, by length."""
        split = [self.word.findall(self.normalized(t)) for t in texts]
        for i, memo in enumerate((self.known, self.parts)):
            if len(memo) > self.remembered or self.letters[i] > self.remembered * LETTERS_A_WORD:
                memo.clear()
                self.letters[i] = 0
        words = {w: self._parts(w) for w in set().union(*split).difference(self.known)}
        new: dict[int, list[str]] = {}
        for part in {p for parts in words.values() for p in parts}.difference(self.parts):
            new.setdefault(len(part), []).append(part)
        for length, same in new.items():
            rows = max(1, (1 << 18) // length)  # bounds the lattice, whatever the words' length
            self.letters[1] += length * len(same)
            for at in range(0, len(same), rows):
                some = same[at : at + rows]
                self.parts.update(zip(some, self.search(some)))
        for w, parts in words.items():
            self.known[w] = b"".join([self.parts[p] for p in parts])
            self.letters[0] += len(w)
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _parts(self, word: str) -> list[str]:
        """A word cut where no piece holds the two characters side by side."""
        if not self.fallback:  # unknown characters in a row make one id
            return [word]
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.touching]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def forget(self) -> None:
        """Give back what words take; a worker lives on when its task is done."""
        self.known, self.parts, self.letters = {}, {}, [0, 0]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_LOADED: dict[str, Pieces] = {}


def load(path: str, remembered: int = REMEMBERED) -> Pieces:
    if path not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path] = Pieces(f.read())
    _LOADED[path].remembered = remembered
    return _LOADED[path]


def _encoded(pieces: Pieces, texts: list) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4") for x in pieces.encode([t or "" for t in texts])]


def _list_column(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate([*ids, np.empty(0, "<u4")]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _decoded_columns(pieces: Pieces, ids: list[np.ndarray]) -> list[pa.Array]:
    text = pa.array([pieces.decode(x) for x in ids], pa.string())
    return [text, pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())]


def _rows(docs: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return rows, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>"


def encode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """(row, ids): every input row as a struct, whatever its columns, and the piece ids of its whole text.

    `model` is a SentencePiece file every worker can read.  Null and empty texts have no ids; rows that
    repeat come as often as they are there.
    """

    def run(batches):
        pieces = load(model)
        for part in pieces_of(batches, "text", CHUNK):
            ids = _encoded(pieces, part["text"].to_pylist())
            yield pa.record_batch([part["row"], _list_column(ids)], names=["row", "ids"])
        pieces.forget()

    rows, kind = _rows(docs, text_col)
    return rows.mapInArrow(run, kind)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(row, ids, decoded, ids_crc32): the text that the ids of each row stand for.

    A space that the model puts before a text is taken off again; bytes that are no UTF-8 become U+FFFD.
    ids_crc32 is that of the ids as little-endian 32-bit numbers.
    """

    def run(batches):
        pieces = load(model)
        for b in batches:
            ids = [np.array(x or [], "<u4") for x in b["ids"].to_pylist()]
            columns = [b["row"], b["ids"], *_decoded_columns(pieces, ids)]
            yield pa.record_batch(columns, names=["row", "ids", "decoded", "ids_crc32"])

    kind = encoded.schema["row"].dataType.simpleString()
    return encoded.select("row", "ids").mapInArrow(run, f"row {kind}, ids array<int>, decoded string, ids_crc32 long")


def round_trip(docs: DataFrame, model: str, text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """decode(encode(docs)) in one pass over the rows, so that a task needs one worker.

    `remembered` words are kept with their ids: more of them take memory of the worker and save time.
    """

    def run(batches):
        pieces = load(model, remembered)
        for part in pieces_of(batches, "text", CHUNK):
            ids = _encoded(pieces, part["text"].to_pylist())
            columns = [part["row"], _list_column(ids), *_decoded_columns(pieces, ids)]
            yield pa.record_batch(columns, names=["row", "ids", "decoded", "ids_crc32"])
        pieces.forget()

    rows, kind = _rows(docs, text_col)
    return rows.mapInArrow(run, f"{kind}, decoded string, ids_crc32 long")
