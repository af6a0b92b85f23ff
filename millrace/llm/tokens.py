"""Token ids in files: frequency-ranked, byte-aligned variable-length, with separate control bytes."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, null_id_back, one_task_each, pieces_of
from millrace.llm.files import new_file, open_file
from millrace.session import scratch_dir, staged

MAGIC = b"MRTOK\x001\n"
HEAD = struct.Struct("<qqqq")  # documents, ids, control bytes, data bytes of a segment
CHUNK = 2 << 20  # bytes of text that are encoded at a time
SEGMENT_IDS = 1 << 20  # a segment is closed once it holds this many ids
CACHED_WORDS = 1_800_000  # chunks a worker remembers; beyond that it starts anew
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII signs but the apostrophe, which may begin a word's ending
WORD_END = "</w>"  # how a vocabulary marks the last piece of a word

MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
# Lengths of the four values of each control byte, two bits each, lowest first.
LENGTHS = (((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control bytes, data bytes, control bytes per document, data bytes per document) of documents in a row.

    Each value takes 1 to 4 little-endian bytes, four lengths go to a control byte, and every document
    starts a control byte of its own.
    """
    ranks, slots = ranks.astype("<u4"), -(-counts // 4) * 4
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(int(slots.sum()), np.uint8)
    codes[_filled(counts, slots)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    ends = np.concatenate([[0], np.cumsum(extra.astype(np.int64) + 1)])[np.cumsum(counts)]
    return control, data, slots // 4, np.diff(ends, prepend=0)


def _filled(counts: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which slots hold a value; the others fill a document's last control byte."""
    at = np.arange(int(slots.sum())) - np.repeat(np.cumsum(slots) - slots, slots)
    return at < np.repeat(counts, slots)


def decode_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """Values of a row of documents with `counts` values each; every document starts a control byte."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    lengths = lengths[_filled(counts, -(-counts // 4) * 4)].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    # Four bytes from every position as one number; a value is those at its start, as many as it has.
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    four = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    return four[starts] & MASKS[lengths]


class WordEncoder:
    """Ids of whole texts from a tokenizer that never joins across white space.

    Such a tokenizer gives a text the ids of its space-separated chunks in turn, so a chunk is encoded once
    and remembered.  Texts are split at ASCII white space only; any other stays inside a chunk for the
    tokenizer to deal with.  Chunks that are letters, or letters and then signs, share the ids of their
    letters; if the tokenizer marks word ends, many of those are encoded in one call and told
    apart by the marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.letters: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.signs: dict[str, bytes] = {"": b""}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [t.split() for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        if len(self.letters) > CACHED_WORDS:
            self.letters.clear()
        if len(self.signs) > CACHED_WORDS:
            self.signs = {"": b""}
        known, letters = self.known, self.letters
        new = list(set().union(*split).difference(known))
        line = b" ".join(new)  # decoded and lower-cased in one go
        whole, parts = [], []
        if new:
            for w, chunk, low in zip(new, line.decode("utf-8", "replace").split(" "), line.lower().decode("utf-8", "replace").split(" ")):
                core = chunk.rstrip(SIGNS)
                if core.isalpha() and (core.isascii() or core.lower().isalpha()):
                    stop = chunk[len(core) :]
                    if stop not in self.signs:
                        self.signs[stop] = self._each([stop])[0]
                    parts.append((w, low[: len(core)], self.signs[stop]))
                else:
                    whole.append((w, chunk))
        cores = list({core for _, core, _ in parts}.difference(letters))
        for at in range(0, len(cores), 256):
            letters.update(zip(cores[at : at + 256], self._words(cores[at : at + 256])))
        known.update([(w, letters[core] + stop) for w, core, stop in parts])
        for at in range(0, len(whole), 8192):
            part = whole[at : at + 8192]
            known.update(zip((w for w, _ in part), self._each([c for _, c in part])))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _each(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters; one by one where the marks do not tell them apart."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._each(words)
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, ids, counts): ids of each text and the end id, little-endian, in two bytes where all fit.

    Each task adds a last row that holds only `counts`: how often it met each id, as 64-bit numbers.
    """

    def run(batches):
        words = encoder(tokenizer)
        end, total = struct.pack("<I", end_id), np.zeros(0, np.int64)
        for part in pieces_of(batches, "text", CHUNK):
            ids = words([t or b"" for t in part["text"].to_pylist()])
            n = np.array([len(x) // 4 + 1 for x in ids], np.int64)
            flat = np.frombuffer(end.join([*ids, b""]), "<u4")
            width = 2 if flat.max() < 1 << 16 else 4
            seen = np.bincount(flat, minlength=len(total))
            seen[: len(total)] += total
            total = seen
            columns = [part["id"], pa.array(n), _binary(flat.astype(f"<u{width}"), n * width), pa.nulls(len(n), pa.binary())]
            yield pa.record_batch(columns, names=ENCODED_NAMES)
        last = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())]
        yield pa.record_batch(last, names=ENCODED_NAMES)

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(run, ENCODED)


ENCODED = "id long, n long, ids binary, counts binary"
ENCODED_NAMES = [c.split()[0] for c in ENCODED.split(", ")]


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column whose values lie one after the other in `data`."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _wide(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, ids per document) of a batch."""
    n = b["n"].to_numpy()
    ids = b["ids"].to_pylist()
    raw = b"".join(ids)
    if len(raw) in (2 * n.sum(), 4 * n.sum()):  # one width throughout
        return np.frombuffer(raw, "<u2" if len(raw) == 2 * n.sum() else "<u4"), n
    return np.concatenate([np.frombuffer(x, f"<u{len(x) // k}").astype("<u4") for x, k in zip(ids, n.tolist())]), n


def write_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Encode every text and write the ids in ascending id order: (manifest, folder).

    The manifest has one row per file: bucket (files in order), file, n_docs, n_tokens.  Ids are ranked by
    how often they occur in all documents, so the common ones take one byte; the ranks are in the
    folder's file `ranks`, one id per rank.  The vocabulary bounds that table and what is counted on the
    driver.  Files are cut at quantiles of the document id, so they follow each other; rows that share an
    id are ordered by their ids' bytes.  Null texts are empty; null ids come first.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    rows = staged(encode(docs, tokenizer, end_id, id_col, text_col), "encoded")
    encoded = rows.where("counts is null").select("id", "n", "ids")

    def count(batches):
        for b in batches:
            for raw in b["counts"].to_pylist():
                n = np.frombuffer(raw, np.int64)
                used = np.flatnonzero(n)
                yield pa.record_batch([pa.array(used), pa.array(n[used])], names=["id", "n"])

    counts = rows.where("counts is not null").select("counts").mapInArrow(count, "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r["id"] for r in sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))]
    id_of = np.array(ranked, "<u4")
    _, out = new_ranks(folder)
    with out:
        out.write(id_of.tobytes())
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of))

    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = encoded.agg(F.percentile_approx("id", [i / files for i in range(1, files)] or [0.5], 100 * files)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    def code(batches):
        for part in pieces_of(batches, "ids", CHUNK):
            ids, n = _wide(part)
            control, data, controls, sizes = encode_ranks(rank_of[ids], n)
            bucket = np.searchsorted(cuts, part["id"].to_numpy(), side="left").astype(np.int32)
            yield pa.record_batch(
                [pa.array(bucket), part["id"], part["n"], _binary(control, controls), _binary(data, sizes)],
                names=["bucket", "id", "n", "control", "data"],
            )

    coded = encoded.mapInArrow(code, "bucket int, id long, n long, control binary, data binary")
    dealt = coded.repartition("bucket").sortWithinPartitions("bucket", "id", "n", "data", "control")
    manifest = dealt.mapInArrow(lambda b: _write(b, folder), "bucket int, file string, n_docs long, n_tokens long")
    return staged(manifest, "manifest"), folder


def new_ranks(folder: str):
    from millrace.llm.files import locate

    fs, path = locate(f"{folder}/ranks")
    fs.create_dir(os.path.dirname(path), recursive=True)
    return f"{folder}/ranks", fs.open_output_stream(path)


def _write(batches, folder: str):
    """One file per bucket; a file is the magic and then segments, each with its documents' ids and counts."""
    bucket, uri, out = None, "", None
    docs = tokens = 0
    held: list[tuple] = []

    def flush():
        if held:
            ids, n, control, data = zip(*held)
            control, data = b"".join(control), b"".join(data)
            out.write(HEAD.pack(len(ids), sum(n), len(control), len(data)))
            out.write(np.array(ids, "<i8").tobytes() + np.array(n, "<i8").tobytes() + control + data)
            held.clear()

    def row():
        flush()
        out.close()
        return pa.record_batch([[bucket], [uri], [docs], [tokens]], schema=MANIFEST)

    waiting = 0
    for b in batches:
        for r in zip(*(b[c].to_pylist() for c in ("bucket", "id", "n", "control", "data"))):
            if r[0] != bucket:
                if out:
                    yield row()
                bucket, docs, tokens, waiting = r[0], 0, 0, 0
                uri, out = new_file(folder, f"ids-{bucket:06d}", ".tok")
                out.write(MAGIC)
            held.append(r[1:])
            docs, tokens, waiting = docs + 1, tokens + r[2], waiting + r[2]
            if waiting >= SEGMENT_IDS:
                flush()
                waiting = 0
    if out:
        yield row()


MANIFEST = pa.schema([("bucket", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def segments(uri: str, id_of: np.ndarray):
    """(document ids, counts, token ids) of each segment of a file."""
    with open_file(uri) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        while head := f.read(HEAD.size):
            docs, n, control, data = HEAD.unpack(head)
            ids = np.frombuffer(f.read(8 * docs), "<i8")
            counts = np.frombuffer(f.read(8 * docs), "<i8")
            ranks = decode_ranks(f.read(control), f.read(data), counts)
            if len(ranks) != n:
                raise ValueError(f"{uri} is damaged: {len(ranks)} ids instead of {n}")
            yield ids, counts, id_of[ranks]


def read_files(manifest: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document in the files; start counts all ids before it."""
    names = ["id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    ahead = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)))

    def run(batches):
        with open_file(f"{folder}/ranks") as f:
            id_of = np.frombuffer(f.read(), "<u4")
        for b in batches:
            for uri, start in zip(b["file"].to_pylist(), b["start"].to_pylist()):
                for ids, counts, tokens in segments(uri, id_of):
                    raw, ends = tokens.astype("<u4").tobytes(), np.cumsum(counts)
                    parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends, counts)]
                    crc = pa.array([zlib.crc32(p) for p in parts], pa.int64())
                    columns = [pa.array(ids), pa.array(start + ends - counts), pa.array(counts), crc]
                    columns += [pa.array(parts, pa.binary())] if with_ids else []
                    yield pa.record_batch(columns, names=names)
                    start += int(ends[-1]) if len(ends) else 0

    found = one_task_each(files.select("file", "start")).mapInArrow(
        run, "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    )
    return found.withColumn("id", null_id_back(F.col("id")))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Write the token files of `docs` and read them back: (id, start, n_tokens, ids_crc32[, ids]).

    One row per document, whatever else `docs` holds: rows that repeat come as often as they are there,
    null and empty texts are the end id alone, a null id sorts first.  Empty input: no file, no row.
    """
    return read_files(*write_files(docs, tokenizer, end_id, id_col, text_col), with_ids)
