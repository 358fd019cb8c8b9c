"""Every source gives its whole quota, however large the blocks are."""

import random

import pytest

import llm_cases as C
from tidemark.llm import mixing as M


def quotas(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(C.WORD.findall(text or ""))
    goal = C.water_fill(sizes)
    return {s: min(int(goal[s] + 0.5), 3 * sizes[s]) for s in sizes}


@pytest.mark.parametrize("slots, block", [(1, 100), (2, 64), (16, 8), (4, 1)])
def test_every_source_gives_its_quota(spark, monkeypatch, slots, block):
    monkeypatch.setattr(M, "SLOTS_PER_SOURCE", slots)
    monkeypatch.setattr(M, "BLOCK_WORDS", block)
    monkeypatch.setattr(M, "CHUNK_ROWS", 7)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 300), rng.choice("abc")) for i in range(90)]
    rows += [(100 + i, "w " * rng.randint(1, 30), f"tiny{i}") for i in range(20)] + [(200, "w", None)]
    taken = {}
    for r in M.taken_words(C.frame(spark, rows).repartition(3)).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert taken == quotas(rows)


def test_blocks_have_one_slot_each(spark):
    for seed in range(3):
        rng = random.Random(seed)
        quota = [rng.randint(0, 10 ** rng.randint(0, 6)) for _ in range(30)]
        slots, block = M.schedule_size(sum(quota), len(quota))
        frame = spark.createDataFrame(list(enumerate(quota, 1)), "source_no long, quota long")
        plan = M.schedule(frame, slots, block).collect()
        assert len({r["slot"] for r in plan}) == len(plan)
        ranks = {}
        for r in plan:
            assert 0 <= r["slot"] < slots
            ranks.setdefault(r["source_no"], []).append(r["rank"])
        assert {n: sorted(v) for n, v in ranks.items()} == {
            n: list(range(-(-q // block))) for n, q in enumerate(quota, 1) if q}
