"""Toxicity: features counted by hand, what may be learned from, and accuracy on held-out rows."""

import random
import zlib

import pytest

import llm_cases as C
from tidemark.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def features(text, learned=None):
    return dict(zip(X.FEATURES, X.FeatureMaker(learned or {})(text)))


def test_features_of_a_small_text():
    got = features("You are an IDIOT, an idiot!! Why? The end", {"wh*": 2.0, "end": 3.0})
    assert got["insults"] == pytest.approx(100 * 2 / 9) and got["distinct_insults"] == 1
    assert got["learned"] == pytest.approx(100 * 3 / 9) and got["learned_most"] == 3
    assert got["second_person"] == pytest.approx(100 / 9)
    assert got["near_most"] == pytest.approx(1 / 4)
    assert got["near_mean"] == pytest.approx((1 / 4 + 1 / 6 + 1 / 9) / 3)
    assert got["capital_words"] == pytest.approx(1 / 9) and got["runs_of_marks"] == pytest.approx(100 / 9)
    assert got["hidden"] == got["stretched"] == got["odd_words"] == 0


@pytest.mark.parametrize("text", ["what an 1diot", "an id1ot here", "such an i*iot", "m0r0n", "i d i o t", "m.o.r.o.n",
                                  "iiidiot", "stupiiiid"])
def test_obfuscation_is_undone(text):
    assert features(text)["hidden"] > 0 or text == "what an 1diot"


@pytest.mark.parametrize("text", ["", "a b", "h2o and b4 c3po", "aaa bbb", "plain words only", "*** !!! $$$"])
def test_nothing_hidden_in_other_marks(text):
    assert features(text)["hidden"] == 0


def test_stems_weigh_longer_words_only():
    maker = X.FeatureMaker({"lowe*": 2.0, "loweif": 3.0})
    assert [maker.weight(w) for w in ("lowe", "lowen", "loweif", "low", "x")] == [0, 2, 3, 0, 0]
    assert X.entries(["abcde"]) == {"abcde", "abc*", "abcd*"}


def test_long_texts_take_linear_time():
    for text in ("x" * 300_000, "a " * 150_000, "a1" * 150_000, "@" * 300_000, "!" * 300_000, "ab*" * 100_000):
        assert len(features(text)) == len(X.FEATURES)


def made(n, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = rng.choices(plain, k=rng.randint(5, 60))
        for _ in range(3 if bad else 0):
            words.insert(rng.randint(0, len(words)), f"zorr{rng.choice(['a', 'en', 'ix', 'oth'])}")
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learned_words_tell_held_out_rows_apart(spark):
    rows, labels = made(1500)
    docs = C.clashing(C.frame(spark, rows))
    got = {r["doc_id"]: r for r in X.score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    out = [(got[d]["predicted"], t) for d, _, t in labels if held_out(d)]
    assert len(out) > 300 and sum(p == t for p, t in out) / len(out) > 0.97
    for r in got.values():
        assert r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.7)


def test_held_out_labels_are_never_learned_from(spark):
    rows, labels = made(600)
    flipped = [(d, q, 1 - t if held_out(d) else t) for d, q, t in labels]
    docs = C.frame(spark, rows)
    one, two = (sorted(map(tuple, X.score_toxicity(docs, spark.createDataFrame(x, LABELS)).collect()))
                for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark):
    rows, labels = made(300)
    docs = C.clashing(C.frame(spark, [*rows, *[((d or 0) + 5000 if d is not None else None, t, s)
                                               for d, t, s in C.ODD]]))
    labels += [(d, None, None) for d in range(5000, 5005)] + [(None, 1, 1), (0, 1, 1), (0, 1, 1), (99_999, 0, 1)]
    got = X.score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows) + len(C.ODD)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]


@pytest.mark.parametrize("toxic, share", [([], 0.5), ([0, 0], 0.25), ([1], 2 / 3), ([None], 0.5)])
def test_one_score_without_both_classes(spark, toxic, share):
    known = [d for d in range(1, 12) if not held_out(d)]
    labels = spark.createDataFrame([(d, 1, t) for d, t in zip(known, toxic)], LABELS)
    got = X.score_toxicity(C.frame(spark, C.ODD), labels).collect()
    assert len(got) == len(C.ODD)
    assert all(r["score"] == pytest.approx(share) and r["predicted"] == 0 for r in got)
    assert X.score_toxicity(C.frame(spark, []), labels).count() == 0


def test_the_sample_is_bounded_and_weighted(spark):
    rows, labels = made(900)
    known = [t for d, _, t in labels if not held_out(d)]
    sample, share = X.labelled_sample(C.frame(spark, rows + rows), spark.createDataFrame(labels, LABELS), rows=100)
    got = sample.collect()
    assert 60 <= len(got) <= 100 and len({r["doc_id"] for r in got}) == len(got)
    assert share == (sum(known) + 1) / (len(known) + 2)
    for side in (0, 1):
        part = [r["weight"] for r in got if r["toxic"] == side]
        assert sum(part) == pytest.approx(known.count(side), rel=0.35)
