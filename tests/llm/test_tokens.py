"""Token files against the tokenizer and plain arithmetic."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import tokens
from tests.llm.odd import documents, plain

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_files_hold_every_document(spark, sf):
    rows = plain(spark, sf)
    got = tokens.token_files(documents(spark, rows), PATH, end_id=2).collect()
    whole = Tokenizer.from_file(PATH)
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [2] for i, t in {(r[0], r[1]) for r in rows}}
    want, start = [], 0
    for i, t in sorted(((r[0], r[1]) for r in rows if r[0] is not None)):
        want.append((i, ids[i]))
    nulls = sorted((whole.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows if r[0] is None), key=len)
    want = [(None, x) for x in nulls] + want
    got = sorted(got, key=lambda r: r["start"])
    for r, (i, x) in zip(got, want):
        raw = np.array(x, "<u4").tobytes()
        assert (r["id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(x), zlib.crc32(raw))
        assert bytes(r["ids"]) == raw
        start += len(x)
    assert len(got) == len(rows)


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=20), max_size=8))
@settings(max_examples=60, deadline=None)
def test_ranks_come_back(rows):
    counts = np.array([len(r) for r in rows], np.int64)
    flat = np.array([x for r in rows for x in r], np.uint32)
    control, data, controls, sizes = tokens.encode_ranks(flat, counts)
    assert tokens.decode_ranks(control.tobytes(), data.tobytes(), counts).tolist() == flat.tolist()
    assert controls.tolist() == [-(-len(r) // 4) for r in rows]
    assert sizes.tolist() == [sum(max(1, -(-x.bit_length() // 8)) for x in r) for r in rows]


@pytest.fixture(scope="module")
def words():
    return tokens.WordEncoder(PATH)


@given(st.lists(st.text(alphabet=st.sampled_from("abS'’.,!?1é̈ßİ漢각 \n\t\x1c\x85 <|>endoftxt#$*-_"), max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_chunks_equal_whole_texts(words, texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in words([t.encode() for t in texts])]
    assert got == [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_empty(spark):
    assert tokens.token_files(documents(spark, []), PATH).count() == 0
