import hashlib

import numpy as np
import pyarrow as pa
import pytest

import llm_cases as C
from tidemark.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t, _ in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("capacity", [X.BUCKET_BYTES, 200])
def test_odd_rows(spark, capacity):
    docs = C.clashing(C.frame(spark, C.ODD))
    assert result(X.exact_duplicates(docs, capacity=capacity)) == brute(C.ODD)


def test_empty_table(spark):
    assert X.exact_duplicates(C.frame(spark, [])).count() == 0


def test_one_text_in_half_of_many_rows(spark):
    rows = [(i, "the same" if i % 2 else f"text {i % 700}", "s") for i in range(5000)]
    docs = C.frame(spark, rows).repartition(16)
    assert result(X.exact_duplicates(docs, capacity=4096)) == brute(rows)


def test_directory_splits_until_buckets_fit():
    rng = np.random.default_rng(1)
    cells = {int(c): int(n) for c, n in zip(rng.choice(1 << 10, 300, False), rng.integers(1, 90, 300))}
    cells[5] = 10_000  # cannot be split below one cell
    directory = X.Directory(cells, 200, bits=10)
    keys = (np.arange(1 << 10, dtype=np.uint64) << np.uint64(54)).view(np.int64)
    buckets = directory.bucket_of(keys)
    assert len(set(buckets.tolist())) == directory.buckets
    assert (np.diff(np.flatnonzero(np.diff(buckets))) > 0).all()
    for b in set(buckets.tolist()):
        own = np.flatnonzero(buckets == b)
        assert (np.diff(own) == 1).all()  # one key range
        load = sum(cells.get(int(c), 0) for c in own)
        assert load <= 200 or (len(own) == 1 and own[0] == 5)


def test_colliding_keys_are_told_apart_by_bytes():
    rows = [(0, 7, "a", 1, 1), (0, 7, "b", 2, 2), (0, 7, "a", 5, 1), (0, 8, "c", None, 3), (0, 8, "c", 4, 1)]
    names = ["bucket", "key", "text", "keep_id", "group_size"]
    batches = [pa.record_batch([pa.array(c) for c in zip(*part)], names=names)
               for part in (rows[:2], rows[2:])]
    got = [tuple(r.values()) for b in X.chain(iter(batches)) for r in b.to_pylist()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [(0, 7, 0, sha("a"), 5, 2), (0, 7, 1, sha("b"), 2, 2), (0, 8, 0, sha("c"), 4, 4)]
