"""Restoring disguised words, and held-out accuracy of the score."""

import random
import zlib

import pytest

from millrace.llm import toxicity
from tests.llm.odd import ODD, documents

PLAIN = "the house stands near a river and people walk along its bank every morning with bread tea books letters music winter summer".split()
BAD = "idiot stupid loser worthless pathetic".split()


def corpus(n=900, seed=2):
    r, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [r.choice(PLAIN) for _ in range(r.randint(5, 60))]
        toxic = r.random() < 0.25
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", ".", ","]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 0, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus()
    odd = [(900, 0, None), (901, None, 1), (None, 0, 1), (5, 0, 0), (777_777, 0, 1)]
    table = spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int")
    return toxicity.train(documents(spark, rows + ODD), table), rows, labels


@pytest.mark.parametrize(
    "disguised, word",
    [("1d10t", "idiot"), ("id!ot", "idiot"), ("$tup1d", "stupid"), ("stuuupid", "stupid"), ("l0s3r", "loser"), ("i.d.i.o.t", "idiot"),
     ("p-a-t-h-e-t-i-c", "pathetic"), ("w0rthle$$", "worthless"), ("iiidioootttt", "idiot"), ("h0use", "house"), ("st*pid", "stupid")],
)
def test_disguised_words(trained, disguised, word):
    assert word in toxicity.restore(disguised, trained[0].chars)


def test_spelt_out_words(trained):
    restorer = toxicity.Restorer(trained[0].chars)
    assert "idiot" in restorer.spaced("you are an i d i o t and".split())
    assert restorer.spaced("a b".split()) == []


def test_plain_words_stay(trained):
    restorer = toxicity.Restorer(trained[0].chars)
    assert restorer.readings("river,") == ["river"]
    assert restorer.readings("letters")[0] == "letters"
    assert restorer.readings("2024") == []


def test_weak_words_count(spark):
    """A word that is only somewhat more frequent in toxic texts is evidence, too."""
    rows, labels = corpus()
    rows = [(i, text + " perhaps" * (i % 20 < (11 if y else 7)), *rest) for (i, text, *rest), (_, _, y) in zip(rows, labels)]
    model = toxicity.train(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert 0 < model.weights["perhaps"] < 0.5
    assert toxicity.Scorer(model.chars, model.weights).evidence("the house perhaps")[0] > 0


@pytest.mark.parametrize("sign", [*toxicity.LEET, *".-_ ²٣½Ⅷ", "!.", "!!", "!|"])
def test_the_filter_changes_no_score(trained, sign):
    """What is not decoded has no weighted feature, whatever sign stands in between."""
    model = trained[0]
    with_filter, without = (toxicity.Scorer(model.chars, model.weights) for _ in range(2))
    without.restorer = toxicity.Restorer(model.chars)
    words = [b[:i] + sign + b[i:] for b in BAD + PLAIN for i in range(1, len(b))]
    words += [x.join(b) for b in BAD + PLAIN for x in (sign, f" {sign} ", f".{sign}")] + [sign.join(b[i : i + 2] for i in range(0, len(b), 2)) for b in BAD]
    assert [with_filter.evidence(w) for w in words] == [without.evidence(w) for w in words]


def test_the_filter_on_letters_changes_no_score(trained):
    """Chunks of letters alone: repeats, features inside, in front and run together."""
    model, draw = trained[0], random.Random(9)
    with_filter, without = (toxicity.Scorer(model.chars, model.weights) for _ in range(2))
    without.restorer = toxicity.Restorer(model.chars)
    words, decoded = [], 0
    for _ in range(4000):
        parts = "".join(draw.choices([*BAD, *PLAIN, "ii", "l", "é", "ll"], k=draw.randint(1, 3)))
        words.append("".join(c * draw.choice([1, 1, 1, 2, 3]) for c in parts))
    assert [with_filter.evidence(w) for w in words] == [without.evidence(w) for w in words]
    decoded = sum(with_filter.restorer.hopeful_letters(w) for w in words)
    assert 0 < decoded < len(words) / 2
    assert decoded < sum(with_filter.restorer.hopeful(w) for w in words)


def cheapest(text, model):
    """The words of the cheapest of all paths through a lattice, each followed to its end."""
    best = None

    def follow(rest, state, cost, done):
        nonlocal best
        if not rest:
            if best is None or cost < best[0] - 1e-9:
                best = cost, done
            return
        for reading, extra in rest[0]:
            s, c = state, cost + extra
            for ch in reading:
                if ch.isalpha():
                    at = s * toxicity._BASE + ord(toxicity._CODES[ord(ch)])
                    c += model.costs[at]
                    s = at % toxicity._STATES
                elif s != toxicity._BEGIN:
                    c += model.costs[s * toxicity._BASE]
                    s = toxicity._BEGIN
            follow(rest[1:], s, c, done + reading)

    follow(toxicity.lattice(text) + [[(" ", 0.0)]], toxicity._BEGIN, 0.0, "")
    return best[0], toxicity._PIECES.findall(best[1])


def test_restoring_against_all_paths(trained):
    model, draw = trained[0].chars, random.Random(4)
    signs = [*toxicity.LEET, *"abdeilost", ".", "-", " "]
    for _ in range(150):
        text = "".join(draw.choice(signs) * draw.choice([1, 1, 2]) for _ in range(draw.randint(1, 6)))
        cost, words = cheapest(text, model)
        got = toxicity.restore(text, model)
        if got != words:  # another path of the same cost
            assert cheapest(" ".join(got), model)[0] <= cost + 1e-6 or pytest.fail(text)


def test_long_chunks_take_time_in_proportion(trained):
    import time

    def seconds(n):
        start = time.perf_counter()
        toxicity.restore("ab1+x/" * n, trained[0].chars)
        return time.perf_counter() - start

    seconds(1000)
    short, long = min(seconds(20_000) for _ in range(2)), seconds(160_000)
    assert long < 16 * short + 1  # eight times the text


@pytest.mark.parametrize("text", ["st!upid", "i!diot", "los!er", "s!t!u!p!i!d", "s.t!u.p!i.d", "s ! t u p i d"])
def test_dropped_exclamation_marks(trained, text):
    model = trained[0]
    assert toxicity.Scorer(model.chars, model.weights).evidence(f"you are {text} now")[0] > 0


def test_held_out_accuracy(spark, trained):
    model, rows, labels = trained
    score = {r["id"]: r["score"] for r in toxicity.scored(documents(spark, rows), model).selectExpr("row.doc_id as id", "score").collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    assert sum((score[i] >= 0.5) == bool(y) for i, y in held) / len(held) > 0.99
    assert sum((score[i] >= 0.5) == bool(y) for i, y in held if y) / sum(y for _, y in held) > 0.98


def test_disguised_texts_score_alike(spark, trained):
    model = trained[0]
    clean = " ".join(PLAIN * 2)
    texts = [clean, f"{clean} idiot", f"{clean} 1d10t", f"{clean} i d i o t", f"{clean} iiidiiiot!!", clean.upper(), f"{clean} 555-1234 a1b2 x@y.z"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    score = {r["id"]: r["score"] for r in toxicity.scored(documents(spark, rows), model).selectExpr("row.doc_id as id", "score").collect()}
    assert all(score[i] >= 0.5 for i in (1, 2, 3, 4)) and all(score[i] < 0.5 for i in (0, 5, 6))


def test_odd_rows_all_have_a_score(spark, trained):
    got = toxicity.scored(documents(spark), trained[0]).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    low = min(r["score"] for r in got)
    assert all(r["score"] == low for r in got if not r["row"]["text"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.scored(documents(spark, []), toxicity.train(documents(spark, []), none)).count() == 0
    model = toxicity.train(documents(spark), none)
    scores = {r["score"] for r in toxicity.scored(documents(spark), model).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(1 / 3)  # nothing says a text is toxic


def test_labels_of_one_class(spark):
    labels = spark.createDataFrame([(i, 0, 0) for i in range(901, 909)], "doc_id long, quality int, toxic int")
    model = toxicity.train(documents(spark), labels)
    assert all(r["score"] < 0.5 for r in toxicity.scored(documents(spark), model).collect())


def test_words_that_can_gain_nothing_are_not_decoded(monkeypatch):
    model = toxicity.CharModel(toxicity.word_grams({"common": 9, "ideas": 5, "stupid": 7, "balloon": 2}))
    weights = {"common": 0.5, "comm~": 0.25, "stupid": 3.0, "stup~": 2.5, "balo~": 1.0, "come": 4.0}
    texts = ["common", "commonly commons", "sttupid", "stuupid ideas", "balloon", "come coome", "", None, "assess common stupid", "c o m e on"]
    every = toxicity.Restorer(model)
    want = []
    for t in texts:
        words = (t or "").lower().split()
        read = [*(r for w in words for r in every.readings(w)), *every.spaced(words)]
        top = sorted((weights[f] for f in {f for r in read for f in toxicity.features(r)} if f in weights), reverse=True)
        want.append(tuple((top + [0.0, 0.0])[:2]))
    decoded = []
    monkeypatch.setattr(toxicity, "restore", lambda text, chars, real=toxicity.restore: decoded.append(text) or real(text, chars))
    scorer = toxicity.Scorer(model, weights)
    assert [scorer.evidence(t) for t in texts] == want
    assert {"sttupid", "stuupid", "balloon", "coome"} <= set(decoded)
    assert not {"common", "commonly", "commons", "assess"} & set(decoded)
