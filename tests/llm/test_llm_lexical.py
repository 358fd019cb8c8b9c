"""Ranked search against scores computed term by term, and the treap against its points."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

import llm_cases as C
from tidemark.llm import lexical_search as S
from tidemark.llm.k2_treap import Treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for d, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort()
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, k):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = S.ranked_search(C.clashing(docs), C.clashing(items), k).collect()
    return sorted((tuple(r) for r in rows), key=str)


def corpus(n, seed, words=40):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + ["Ünder", "x-y", "A1"]
    weight = [1 / (i + 1) for i in range(len(names))]
    docs = [(i, " ".join(rng.choices(names, weight, k=rng.randint(0, 60)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(names, k=rng.randint(1, 9)))) for i in range(12)]
    return docs, items


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_DOCS", 37)
    docs, items = corpus(400, 1)
    for k in (1, 7, 1000):
        assert search(spark, docs, items, k) == brute(docs, items, k)


def test_tiles_by_points_and_items_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE_POINTS", 100)
    monkeypatch.setattr(S, "BLOCK_TERMS", 9)
    docs, items = corpus(150, 2)
    assert search(spark, docs, items, 5) == brute(docs, items, 5)


def test_a_file_holds_each_tile_by_itself(spark, monkeypatch):
    """Writers and readers hold a row group at once: one tile, whatever a task makes."""
    monkeypatch.setattr(S, "TILE_DOCS", 10)
    docs, items = corpus(120, 5)
    rows = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    index, _ = S.build_index(rows)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in index.inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.metadata.num_row_groups)]
    assert len(groups) > 5 and {g.num_rows for g in groups} == {1}


def test_odd_rows_ties_and_copies(spark):
    docs = [(d, t) for d, t, _ in C.ODD] + [(100 - i, "Tie tie breaks") for i in range(30)] + [
        (None, "tie"), (None, "tie"), (50, "tie breaks breaks")]
    items = [(1, "tie"), (2, None), (3, ""), (4, "?!"), (5, "breaks one WORD"), (5, "éÀ"), (None, "中文 many"),
             (6, "absent"), (7, "many " * 5000 + "x" * 30_000)]
    assert search(spark, docs, items, 8) == brute(docs, items, 8)


def test_empty_tables(spark):
    docs, items = corpus(20, 3)
    assert search(spark, docs, [], 5) == [] and search(spark, [], items, 5) == []
    assert search(spark, [(1, None), (2, " .")], items, 5) == []


def test_the_treap_keeps_every_point():
    rng = np.random.default_rng(4)
    for points, width in ((1, 1), (300, 9), (5000, 700)):
        names = rng.integers(0, 2 ** 64, max(1, points // 4), dtype=np.uint64)
        pairs = np.unique(np.stack([rng.choice(names, points), rng.integers(0, width, points).astype(np.uint64)]),
                          axis=1)
        rows, columns = pairs[0], pairs[1].astype(np.int64)
        impacts = rng.integers(1, 1 << 20, len(rows))
        stored = Treap.build(rows, columns, impacts, width).dump()
        treap = Treap.load(**{**stored, "terms": stored["terms"].copy()})
        for name in np.unique(rows)[:40]:
            got = [(int(c), int(s)) for cs, ss in treap.search(np.array([name]), np.array([1]), lambda: 1)
                   for c, s in zip(cs, ss)]
            at = rows == name
            assert sorted(got) == sorted(zip(columns[at].tolist(), impacts[at].tolist()))
            assert treap.frequency[treap.places(np.array([name]))[0][0]] == at.sum()
        for depth, mask in enumerate(treap.masks):  # no cell is below its quarters
            ends = np.cumsum([bin(m).count("1") for m in mask])
            parts = np.split(treap.maxima[depth + 1], ends[:-1])
            assert [p.max() for p in parts] == treap.maxima[depth].tolist()


def test_low_bounds_stay_closed():
    """With a high k-th score, a search opens few cells."""
    terms_of = np.repeat(np.arange(4, dtype=np.uint64), 1000)
    columns = np.tile(np.arange(1000), 4)
    impacts = np.where(columns == 17, 900, 10)
    treap = Treap.build(terms_of, columns, impacts, 1000)
    got = list(treap.search(np.arange(4, dtype=np.uint64), np.ones(4, np.int64), lambda: 3000))
    assert [(c.tolist(), s.tolist()) for c, s in got] == [([17], [3600])]
