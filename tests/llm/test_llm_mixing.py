import random

import pytest

import llm_cases as C
from tidemark.llm import mixing as M


def check(spark, rows, monkeypatch, slots=16, block=8, chunk=7):
    monkeypatch.setattr(M, "SLOTS_PER_SOURCE", slots)
    monkeypatch.setattr(M, "BLOCK_WORDS", block)
    monkeypatch.setattr(M, "CHUNK_ROWS", chunk)
    size, goal, taken = C.mixed_words(rows, C.draws(spark, rows), slots, block)
    docs = C.clashing(C.frame(spark, rows)).drop("row_id")
    number = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, doc_id long, text string, source string")
    got = M.taken_rows(number.repartition(3), row_col="n").collect()
    assert {r["row_id"]: (r["doc_id"], r["source"], r["size"], r["taken"]) for r in got} == {
        i: (d, s, n, taken[i]) for i, ((d, _, s), n) in enumerate(zip(rows, size))}
    for r in got:
        assert r["target"] == pytest.approx(goal[r["source"]], rel=1e-9)
        assert r["taken"] <= 3 * r["size"]
    plain = M.taken_words(docs.repartition(3))
    assert plain.columns == ["doc_id", "size", "source_size", "target", "taken", "source"]
    known = sorted(str((r["doc_id"], r["size"], r["taken"])) for r in got if r["doc_id"] is not None)
    assert sorted(str((r["doc_id"], r["size"], r["taken"])) for r in plain.where("doc_id is not null").collect()) == known
    return got


def test_slot_by_slot(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", "é", None, "Z"])) for i in range(90)]
    check(spark, rows, monkeypatch)
    check(spark, rows, monkeypatch, slots=64, block=1024)


def test_odd_rows(spark, monkeypatch):
    rows = [(d, (t or "")[:300] if d == 10 else t, s) for d, t, s in C.ODD]
    check(spark, rows, monkeypatch)


def test_hot_source_and_tiny_ones(spark, monkeypatch):
    rows = [(i, "w " * 9, "hot") for i in range(150)] + [(200, "w", "a"), (201, "w w", "b"), (202, "", "c")]
    got = check(spark, rows, monkeypatch)
    assert {r["taken"] for r in got if r["source"] in "ab"} <= {0, 1, 2, 3, 6}


def test_targets_share_the_excess(spark):
    rng = random.Random(4)
    for _ in range(3):
        sizes = {f"s{i}": rng.randint(0, 10 ** rng.randint(1, 6)) for i in range(12)} | {None: 50}
        frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in M.targets(frame).collect()}
        assert got == pytest.approx(C.water_fill(sizes), rel=1e-9)


def test_nothing_to_mix(spark):
    assert M.taken_words(C.frame(spark, [])).count() == 0
    got = M.taken_words(C.frame(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_mix_pieces_fill_slots_in_order(spark, small):
    rows, mixed = M.mix(spark.read.parquet(f"{small}/documents.parquet"))
    own = {r["row_id"]: r for r in rows.collect()}
    pieces = mixed.collect()
    slots, block = M.schedule_size(sum(r["size"] for r in own.values()), 20)
    filled, source = {}, {}
    for p in pieces:
        assert 0 <= p["from_word"] and p["from_word"] + p["n_words"] <= own[p["row_id"]]["size"]
        filled[p["slot"]] = filled.get(p["slot"], 0) + p["n_words"]
        assert source.setdefault(p["slot"], own[p["row_id"]]["source"]) == own[p["row_id"]]["source"]
    assert max(filled.values()) == block
    assert sum(n < block for n in filled.values()) <= 2 * 20  # the last block of each source
    for half in (range(slots // 2), range(slots // 2, slots)):  # any stretch is close to the targets
        for s in set(source.values()):
            part = sum(filled.get(j, 0) for j in half if source.get(j) == s)
            goal = next(r["target"] for r in own.values() if r["source"] == s)
            assert abs(part - goal / 2) < 4 * block


def test_reruns_agree(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = sorted(map(tuple, M.taken_words(docs).collect()))
    assert first == sorted(map(tuple, M.taken_words(docs.repartition(7)).collect()))
    by = {}
    for r in first:
        by.setdefault(r[5], [0, r[3]])[0] += r[4]
    assert all(abs(taken - goal) <= 0.01 * goal for taken, goal in by.values())


def test_rows_without_an_id_spread_over_chunks(spark):
    """However many rows have no id, or share one, their places differ."""
    rows = [(None if i % 2 else 7, f"w{i}", "a") for i in range(500)]
    assert len(set(C.draws(spark, rows).values())) == 500
    got = M.taken_words(C.frame(spark, rows)).collect()
    assert len(got) == 500 and sum(r["taken"] for r in got) == 500
