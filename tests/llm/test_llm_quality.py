import pytest

import llm_cases as C
from tidemark.llm import host_quality as H


@pytest.mark.parametrize("text", [t for _, t, _ in C.ODD if t] + [
    "a b c d e a b c d e", "x\nx\n \n \n\ny\ny", "a a a a a a a", "## $$ <b>\nß ß\r\nß ß\x0bq", "",
    "\u00a0 \u2003 a\x1cb", "same line\nsame line \nsame line"])
def test_measures(text):
    assert H.measures(text.encode()) == C.quality(text)


def test_verdicts(spark):
    good = "a fine text of more than ten different words that nobody says twice here"
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "bad", "bad") for i in range(40)]
    rows += [(200, good, "bad"), (201, good, None), (202, None, None), (203, "", "lone")]
    rows += [(204, good, "good")] * 2
    got = {r["doc_id"]: r for r in H.judge(C.clashing(C.frame(spark, rows))).collect()}
    assert all(got[d]["base_failed"] == (t != good) for d, t, _ in rows)
    assert got[0]["kept"] and got[204]["kept"] and not got[100]["kept"]
    assert not got[200]["kept"] and not got[200]["base_failed"]  # its host is condemned
    assert 0 < got[0]["host_rate"] < 0.2 < 0.8 < got[200]["host_rate"] < 1
    assert got[201]["host_rate"] == got[202]["host_rate"]
    assert H.judge(C.frame(spark, rows)).count() == len(rows)


def test_small_hosts_shrink_towards_all(spark):
    good = "a fine text of more than ten different words that nobody says twice here"
    rows = [(i, "bad" if i % 10 == 0 else good, f"h{i % 7}") for i in range(700)]
    rows += [(1000, "bad", "tiny")]
    rate = {r["doc_id"]: r["host_rate"] for r in H.judge(C.frame(spark, rows)).collect()}
    assert 0.1 <= rate[1000] < 0.5


@pytest.mark.parametrize("text", ["bad", "a fine text of more than ten different words that stands here once"])
def test_all_alike(spark, text):
    kept = {r["kept"] for r in H.judge(C.frame(spark, [(i, text, "s") for i in range(5)])).collect()}
    assert kept == {text != "bad"}


def test_empty_table(spark):
    assert H.judge(C.frame(spark, [])).count() == 0
