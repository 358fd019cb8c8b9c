import zlib

import pytest

import llm_cases as C
from tidemark.llm import language as L
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def found(spark, small):
    return QUERIES["op4_language"](spark, small).collect()


def test_held_out_accuracy(spark, small, found):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    out = [r for r in found if r["held_out"]]
    assert len(out) > 200
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) / len(out)
    assert right >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)


def test_texts_without_letters(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(300)
    model = L.fit(docs)
    odd = C.clashing(C.frame(spark, [*C.ODD, (20, "12 34 !!", "a"), (21, "中", "a")]))
    got = {r["doc_id"]: r for r in L.predict_language(odd, model).collect()}
    for d in (3, 4, 8, 20):
        assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0.0)
    assert got[21]["lang_pred"] in model.langs and not got[None]["held_out"]
    kept = L.accepted(odd, model)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, *_ in C.ODD} - {3, 4, 8} | {21}


def test_nothing_to_learn_from(spark):
    docs = C.frame(spark, C.ODD).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert L.fit(docs) is None
    assert {r["lang_pred"] for r in L.identify(docs).collect()} == {"und"}
    assert L.identify(C.frame(spark, [])).count() == 0


def test_one_language_is_always_it(spark):
    got = L.identify(C.frame(spark, C.ODD)).where("doc_id = 1").first()
    assert got["lang_pred"] == "en" and got["score"] == 1.0


def test_unlisted_languages_are_their_own_family(spark):
    rows = [(i, ("tlh qapla batleth " if i % 2 else "dothraki khal vezhven ") * 9,
             "tlh" if i % 2 else "dor") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs)
    assert model.families == ["dor", "tlh"] and not model.duels
    assert all(r["lang_pred"] == ("tlh" if r["doc_id"] % 2 else "dor")
               for r in L.predict_language(docs, model).collect())


def made(n, same_id=None, same_text=False):
    words = {"en": "the cat and the house ", "xx": "zorg blick wuk tarn "}
    return [(same_id, words["en" if i % 2 else "xx"] * 3 + ("" if same_text else f"n{i}"), "en" if i % 2 else "xx")
            for i in range(n)]


KNOWN = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1)


@pytest.mark.parametrize("same_id, same_text", [(None, False), (KNOWN, False), (None, True), (KNOWN, True)])
def test_rows_without_an_id_or_with_one_are_sampled(spark, same_id, same_text):
    docs = spark.createDataFrame(made(20_000, same_id, same_text), "doc_id long, text string, lang string")
    model = L.fit(docs, rows=400)
    assert model.langs == ["en", "xx"]
    got = L.predict_language(docs, model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"en": 10_000, "xx": 10_000}


def test_a_sample_holds_its_bound_and_every_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "LanguageModel", lambda x, langs, families: seen.append(langs))
    rows = [(i, f"word{i % 7} text {i}", f"l{i % 1500:04}") for i in range(6000)]
    rows += [(10_000 + i, f"more {i}", "l0000") for i in range(3000)]
    L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=3000)
    known = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(seen[0]) <= 3000 and set(seen[0]) == known and len(known) > 1400


def test_many_languages(spark):
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{c}" for c in "abcdefgh"), f"l{i % 1500:04}")
            for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, rows=1500)
    assert len(model.langs) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(1500))
    assert L.predict_language(docs.limit(5), model).count() == 5


def test_a_frame_of_ones_own(tmp_path):
    """Nothing but the operator itself makes the session ready."""
    import subprocess
    import sys
    from pathlib import Path
    code = ("from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local-cluster[1,1,1024]').config('spark.ui.enabled', 'false')"
            f".config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
            "import os, sys; sys.path.insert(0, os.environ['OWN'])\n"
            "from tidemark.llm import language as L\n"
            "d = s.createDataFrame([(i, 'some text here', 'en') for i in range(9)], 'doc_id long, text string, lang string')\n"
            "assert L.fit(d).langs == ['en']\n")
    import os
    env = {**os.environ, "OWN": str(Path(__file__).resolve().parents[2])}
    env.pop("PYTHONPATH", None)
    subprocess.run([sys.executable, "-c", code], check=True, env=env, cwd=tmp_path, timeout=300)
