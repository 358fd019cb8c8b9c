"""The Merkle manifest against a plain recursion, for odd rows and trees of several pieces."""

import hashlib
import zlib

import pytest

import llm_cases as C
from tidemark.llm import merkle as M


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def fold(nodes, at, value):
    """Top, proof parts of position ``at`` and the top with ``value`` there."""
    proof = []
    while len(nodes) > 1:
        low = at - at % 16
        run = nodes[low:low + 16]
        proof += run[:at - low] + run[at - low + 1:]
        value = sha(*run[:at - low], value, *run[at - low + 1:])
        nodes = [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], proof, value


def brute(rows):
    """Rows of (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for d, t, lang, s, n in rows:
        leaf, other = (sha(*map(field, (d, s, lang, n, x))) for x in (t, lowered(t)))
        hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        trees.setdefault(s, []).append((d is not None, d or 0, leaf, other if hit else leaf, d))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(trees[s], key=lambda r: r[:3]) for s in order}
    tops = [fold([r[2] for r in trees[s]], 0, "")[0] for s in order]
    out = []
    for i, s in enumerate(order):
        nodes = [r[2] for r in trees[s]]
        for at, (_, _, leaf, other, d) in enumerate(trees[s]):
            top, proof, value = fold(nodes, at, other)
            root, rest, value = fold(tops, i, value)
            out.append((d, leaf, top, root, sha(*proof, *rest), value, value == root))
    return sorted(out, key=str)


def check(spark, rows, **how):
    docs = C.clashing(spark.createDataFrame(rows, C.SCHEMA)).repartition(3)
    got = sorted((tuple(r) for r in M.merkle_manifest(docs, **how).collect()), key=str)
    assert got == brute(rows)
    return got


def test_odd_rows(spark):
    rows = [(d, t, None if d == 3 else "en", s, d) for d, t, s in C.ODD]
    rows += [(None, None, None, None, None)] * 2 + [(7, "Word", "en", "É", 1), (8, "A", "en", "Z", 1)]
    check(spark, rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_pieces_of_any_size_make_the_same_trees(spark, levels):
    sources = {"hot": 300, "a": 1, "b": 16, "c": 17, **{f"s{i:02}": 1 + i % 3 for i in range(20)}}
    rows, at = [], 0
    for s, n in sources.items():
        for _ in range(n):
            rows.append((at, f"Text {at}", "en", s, at))
            at += 1
    got = check(spark, rows, levels=levels)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_every_row_repeated(spark):
    check(spark, [(5, "Same", "en", "a", 4)] * 40)


def test_one_row_and_none(spark):
    (row,) = check(spark, [(1, "x", "en", None, 1)])
    assert row[1] == row[2] == row[3] and row[4] == sha()
    assert M.merkle_manifest(spark.createDataFrame([], C.SCHEMA)).count() == 0


def test_a_parent_resumes_its_states():
    children = [sha(str(i)).encode() for i in range(16)]
    parent = M.Parent(children)
    for slot in range(16):
        other = sha("other").encode()
        changed = children[:slot] + [other] + children[slot + 1:]
        assert parent.fold(slot, other) == M.Parent(changed).digest
        assert parent.others(slot) == b"".join(children[:slot] + children[slot + 1:])


def test_paths_survive_packing():
    runs = [b"".join(sha(f"{k}{i}").encode() for i in range(k + 1)) for k in (0, 4, 15)]
    steps = [(0, runs[0]), (3, runs[1]), (15, runs[2])]
    assert [(p.text, slot) for p, slot in M.unpack(M.pack(steps))] == [(t, s) for s, t in steps]
