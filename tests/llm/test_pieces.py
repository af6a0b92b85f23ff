"""Piece ids against the SentencePiece library, for both kinds of model."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from millrace.llm import pieces
from tests.llm.odd import documents, plain

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " a", "a  b   c ", "▁ ▁▁x", "<s></s><unk>", "    def f(x):\n\t\treturn x  \n", "东京 \U0001f600 \x00", "aaaaaaaaaaaaaaa bbbbbbbbb", "\n\n \n"]


@pytest.fixture(scope="module")
def bpe():
    return pieces.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def unigram():
    """The same pieces read as a unigram model, with scores under which sums seldom tie."""
    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = pieces.UNIGRAM
    rng = np.random.default_rng(4)
    for p in model.pieces:
        if p.type == pieces.NORMAL:
            p.score = -float(rng.uniform(4, 6)) - 6 / len(p.piece)
    data = model.SerializeToString()
    return pieces.Pieces(data), sentencepiece.SentencePieceProcessor(model_proto=data)


def test_bpe_ids_equal_the_library(bpe, sf, spark):
    ours, library = bpe
    texts = [t or "" for _, t, _, _ in plain(spark, sf)] + ODD
    for t, ids in zip(texts, ours.encode(texts)):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == library.encode(t)
        assert ours.decode(ids) == library.decode(ids.tolist())


def test_unigram_ids_equal_the_library(unigram, sf, spark):
    """Short texts, as the library sums scores in single precision; where sums tie, either may be taken."""
    ours, library = unigram
    words = [t.split(" ")[:600] for _, t, _, _ in plain(spark, sf) if t]
    texts = [" ".join(w[i : i + 6]) for w in words for i in range(0, len(w), 6)] + ODD
    score = np.array([library.get_score(i) for i in range(library.get_piece_size())])
    other = 0
    for t, ids in zip(texts, ours.encode(texts)):
        ids, want = np.frombuffer(ids, "<u4"), library.encode(t)
        assert ours.decode(ids) == library.decode(want)
        if ids.tolist() != want:
            other += 1
            assert score[ids].sum() == pytest.approx(score[want].sum(), abs=1e-3)
    assert other < len(texts) / 200


@given(st.lists(st.text(alphabet=st.sampled_from("aeinrst  ▁\n\té東\U0001f600.,'THx"), max_size=40), max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text(bpe, texts):
    ours, library = bpe
    found = [np.frombuffer(x, "<u4").tolist() for x in ours.encode(texts)]
    assert found == library.encode(texts)
    assert [ours.decode(np.array(x, "<u4")) for x in found] == [t.replace("▁", " ") for t in texts]


def test_rows_come_back(spark, sf):
    rows = plain(spark, sf, 50)
    docs = documents(spark, rows)
    got = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert sorted(map(str, pieces.round_trip(docs, PATH).collect())) == sorted(map(str, got))
    assert sorted(str(r["row"]["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in got:
        assert r["ids"] == library.encode(r["row"]["text"] or "")
        assert r["decoded"] == (r["row"]["text"] or "")


def test_empty(spark):
    assert pieces.decode(pieces.encode(documents(spark, []), PATH), PATH).count() == 0
