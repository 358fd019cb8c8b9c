import random

import numpy as np
import pytest

import llm_cases as C
from tidemark.llm import near_dedup as N
from tidemark.llm.components import connected_components
from tidemark.llm.words import SLICE, hashed_words, shingle_set, word_hashes


def result(df):
    rows = df.select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def edited(words, n, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"edit{rng.randint(0, 10 ** 9)}"
    return " ".join(words)


def test_odd_rows(spark):
    rows = [(d, t) for d, t, _ in C.ODD if d is not None]
    docs = C.clashing(C.frame(spark, C.ODD))
    got = N.near_duplicates(docs)
    assert got.count() == len(C.ODD)
    assert result(got.where("doc_id is not null")) == C.near_components(rows)
    lone = got.where("doc_id is null").first()
    assert lone["component_id"] is None and lone["kept"]


def test_empty_table(spark):
    assert N.near_duplicates(C.frame(spark, [])).count() == 0


def test_groups_chains_and_shared_passages(spark):
    rng = random.Random(3)
    rows, n = [], 0

    def add(text):
        nonlocal n
        n += 1
        rows.append((n * 7 % 1009, text, "s"))

    passage = [f"p{i}" for i in range(60)]
    for _ in range(60):  # share a passage, are not similar
        add(" ".join([f"w{rng.randint(0, 10 ** 6)}" for _ in range(80)] + passage))
    base = [f"b{i}" for i in range(300)]
    for _ in range(80):  # near copies of one text, at and below the threshold between each other
        add(edited(base, rng.randint(1, 9), rng))
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):  # each links to the next ones only
        add(" ".join(chain[i * 6:] + [f"d{j}" for j in range(i * 6)]))
    for _ in range(40):
        add(" ".join(base))
    for _ in range(200):
        add(" ".join(f"r{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(1, 60))))
    got = result(N.near_duplicates(C.frame(spark, rows)))
    assert got == C.near_components([(d, t) for d, t, _ in rows])


def test_threshold_is_inclusive(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    other = words[:89] + [f"x{i}" for i in range(4)]
    both = len(C.shingles(" ".join(words)) & C.shingles(" ".join(other)))
    rows = [(1, " ".join(words), "s"), (2, " ".join(words[:89]), "s"), (3, " ".join(words[:88]), "s")]
    assert both == 85
    got = result(N.near_duplicates(C.frame(spark, rows)))
    assert got == C.near_components([(d, t) for d, t, _ in rows])
    assert got[2] == (85, 1)


def test_given_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(N.near_duplicates(docs)) == C.near_components(rows)


def test_pairs_across_labels(spark):
    rows = [(1, 10, 10, [7, 9], 1), (2, 10, 10, [8, 9], 1), (3, 10, 10, [9], 3), (4, 10, 10, [9], 4),
            (5, 10, 10, [9], 1), (6, 10, 8, [8], 1), (7, 10, 10, [8, 9], 7), (30, 100, 99, [7], 3)]
    known = spark.createDataFrame(rows, "rep long, size long, common int, keys array<long>, label long")
    got = [tuple(sorted((r["u"], r["v"]))) for r in N.across(known).collect()]
    assert sorted(got) == [(1, 3), (1, 4), (1, 7), (2, 3), (2, 4), (2, 7), (3, 4), (3, 5), (3, 7),
                           (4, 5), (4, 7), (5, 7)]


def test_linked_sets_share_a_rare_shingle(spark):
    rng, rows = random.Random(11), []
    base = [rng.randint(0, 10 ** 9) for _ in range(60)]
    for rep in range(60):
        own = set(rng.sample(base, rng.randint(40, 60)))
        own |= {rng.randint(0, 10 ** 9) for _ in range(rng.randint(0, 8))}
        rows.append((rep, len(own), rep // 3, sorted(own)))
    members = spark.createDataFrame([r[:3] for r in rows], "rep long, size long, label long")
    sets = spark.createDataFrame([(r[0], r[3]) for r in rows], "rep long, shingles array<long>")
    known = N.rarest(members, sets)
    labelled = known.join(members.select("rep", "label"), "rep")
    got = {tuple(sorted((r["u"], r["v"]))) for r in N.across(labelled).collect()}
    linked = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[2] != b[2]
              and 100 * len(set(a[3]) & set(b[3])) >= 85 * len(set(a[3]) | set(b[3]))}
    assert linked and linked <= got


def test_central_member_meets_other_labels(spark):
    rows = [(1, 5, 100, 60, 5), (1, 6, 100, 99, 6), (1, 7, 100, 98, 7), (1, 8, 100, 99, 8),
            (1, 9, 100, 98, 6), (1, 4, 100, 50, 4)]
    frame = spark.createDataFrame(rows, "bucket long, rep long, size long, common int, label long")
    got = {(r["u"], r["v"]) for r in N.central_pairs(frame).collect()}
    assert got == {(6, 7), (6, 8)}


@pytest.mark.parametrize("similarity", [0.5, 0.85])
def test_signatures_estimate_similarity(similarity):
    rng, shares = np.random.default_rng(4), []
    for _ in range(30):
        pool = rng.integers(0, 2 ** 64, 2000, dtype=np.uint64)
        both = int(len(pool) * similarity)
        side = both + (len(pool) - both) // 2
        a, b = pool[:side], np.concatenate([pool[:both], pool[side:]])
        (low_a, high_a), (low_b, high_b) = N.signature(np.sort(a)), N.signature(np.sort(b))
        shares.append(((low_a == low_b).mean() + (high_a == high_b).mean()) / 2)
    assert abs(np.mean(shares) - similarity) < 0.02


def test_bands_meet_at_the_threshold():
    rng, missed = np.random.default_rng(6), 0
    for _ in range(300):
        pool = rng.integers(0, 2 ** 64, 400, dtype=np.uint64)
        a, b = N.band_keys(pool[:370]), N.band_keys(pool[30:])
        missed += not set(a.tolist()) & set(b.tolist())
    assert missed == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(a, rng.randint(0, 400)) for a in (rng.randint(0, 400) for _ in range(250))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(300)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["vertex"]: r["component"] for r in
           connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def test_words_of_long_texts_are_whole():
    word = b"w" * (SLICE + 5)
    text = b" ".join([b"alpha beta", word, b"gamma"] * 3 + [b"delta " * (SLICE // 3)])
    hashes, start, end = hashed_words(text)
    want = text.split()
    assert [text[a:b] for a, b in zip(start, end)] == want
    one = {w: word_hashes(w)[0] for w in set(want)}
    assert [one[w] for w in want] == hashes.tolist() and len(set(one.values())) == len(one)


def test_short_texts_are_one_shingle():
    assert len(shingle_set(b"")) == len(shingle_set(b" \n")) == 0
    assert len(shingle_set(b"a b c d")) == 1 and shingle_set(b"A b") == shingle_set(b" a\x0bB ")
    assert shingle_set(b"a b") != shingle_set(b"a b c") and shingle_set(b"a b") != shingle_set(b"b a")


def test_an_id_with_several_texts_is_one_document(spark):
    """Everything that one text of an id is linked with is linked with all of them."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (6, b), (9, c), (7, c + " more"), (7, a + " more"), (8, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in N.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert got == {3: {(3, True)}, **{d: {(3, False)} for d in (5, 6, 7, 9)}, 8: {(8, True)}}
