"""The pipeline's stages on rows that share an id, have none, or carry no language."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
import llm_cases as C
from tidemark.llm import mixing


def texts(seed, n, words=40):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(words)) for _ in range(n)]


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=str)


def test_a_table_delivered_twice_leaves_once(spark):
    docs = C.frame(spark, [(i, t, "s") for i, t in enumerate(texts(1, 30))])
    twice = docs.unionByName(docs).repartition(3)
    assert ids(P.without_copies(spark, twice, "")) == ids(docs)
    assert ids(P.without_near_copies(spark, twice, "")) == ids(docs)


def test_one_of_equal_texts_stays_with_or_without_ids(spark):
    a, b, c = texts(2, 3)
    rows = [(None, a, "x"), (None, a, "y"), (None, a, "x"), (4, b, "x"), (None, b, "x"), (4, b, "y"),
            (3, b, "x"), (4, c, "x"), (4, c, "x"), (9, None, "x"), (9, "", "x"), (None, "", "x")]
    got = P.without_copies(spark, C.frame(spark, rows).repartition(4), "").collect()
    assert Counter((r["doc_id"], r["text"] or "") for r in got) == Counter(
        [(None, a), (4, b), (4, c), (9, "")])


def test_near_copies_that_share_an_id_or_have_none(spark):
    a, b, c = texts(3, 3, 100)
    rows = [(None, a, "x"), (None, a + " more", "x"), (None, b, "x"), (7, b + " more", "x"),
            (5, b + " other", "x"), (7, c, "x"), (7, c + " more", "x"), (7, "", "x")]
    got = P.without_near_copies(spark, C.frame(spark, rows).repartition(4), "").collect()
    found = sorted((str(r["doc_id"]), r["text"][:20]) for r in got)
    assert found == sorted([("None", a[:20]), ("5", b[:20]), ("7", c[:20]), ("7", "")])


def test_rows_without_an_id_are_mixed_each_for_itself(spark):
    rng = random.Random(4)
    rows = [(None if i % 3 else 1, " ".join([f"d{i}"] * rng.randint(1, 60)), "abc"[i % 3 if i > 9 else 0])
            for i in range(60)]
    docs = C.frame(spark, rows)
    size = {r[1].split()[0]: (r[2], len(r[1].split())) for r in rows}
    target = {r["source"]: r["target"] for r in mixing.taken_rows(docs).select("source", "target").distinct().collect()}
    got = Counter(r["text"].split()[0] for r in P.mixed(spark, docs, "").collect())
    assert max(got.values()) <= 3 and len({got[d] for d in size}) > 1
    for source, goal in target.items():
        words = sum(n * size[d][1] for d, n in got.items() if size[d][0] == source)
        assert abs(words - goal) <= 30 + 1  # half of the longest document, and rounding


def test_texts_stay_where_no_row_is_labelled(spark):
    docs = C.frame(spark, [*C.ODD, (20, "12 34 !!", "a")]).withColumn("lang", F.lit(None).cast("string"))
    got = P.with_language(spark, docs, "")
    assert got.schema == docs.schema
    assert ids(got) == sorted((d for d, t, _ in C.ODD if t and t.strip()), key=str)


def test_emitted_words_are_near_the_targets(spark):
    rng = random.Random(6)
    rows = [(i, " ".join([f"d{i}"] * rng.randint(1, 90)), rng.choice("abcd")) for i in range(80)]
    rows += [(100, "d100 " * 2000, "long"), (101, "d101 " * 4000, None), (102, "d102", "one"), (103, "", "none")]
    docs = C.frame(spark, rows)
    size, target, taken, cut, emitted = {}, {}, {}, {}, Counter()
    for r in mixing.taken_rows(docs, row_col="doc_id").collect():
        size[r["doc_id"]], target[r["source"]] = r["size"], r["target"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        if r["size"] and r["taken"] % r["size"]:
            cut.setdefault(r["source"], []).append(r["size"])
    for r in P.mixed(spark, docs, "").collect():
        emitted[r["source"]] += size[r["doc_id"]]
    assert 0 < target[None] < 2000  # less than half of its only document
    for source, goal in target.items():
        assert len(cut.get(source, [])) <= 1
        assert (emitted[source] > 0) == (goal >= 0.5)
        if source is not None:
            assert abs(emitted[source] - goal) <= max(cut.get(source, [0])) / 2 + 1
    assert emitted[None] == 4000


def test_languages_that_are_not_wanted_go_by_prediction(spark, monkeypatch):
    rows = [(i, ("tlh qapla batleth " if i % 2 else "dothraki khal vezhven ") * 9,
             "tlh" if i % 2 else "dor") for i in range(60)]
    rows.append((60, "qapla batleth tlh " * 9, "dor"))  # the label does not decide
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert P.with_language(spark, docs, "").count() == 61
    monkeypatch.setattr(P, "LANGUAGES", frozenset({"dor"}))
    assert ids(P.with_language(spark, docs, "")) == sorted(range(0, 60, 2), key=str)
    with pytest.raises(ValueError):
        P.with_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), "").count()
