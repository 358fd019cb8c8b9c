"""Queries against their SQL, and the pipeline against a brute-force version."""

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import compare
import corpus_pipeline as P
import llm_cases as C
from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES, SQL, WORD_BPE


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, tiny, name):
    got = compare.from_spark(QUERIES[name](spark, tiny))
    want = compare.from_duck(compare.duck(tiny), SQL[name])
    assert compare.difference(got, want) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_license_scan", "op11_lexical_search"}))
def test_row_counts(spark, tiny, name):
    n = QUERIES[name](spark, tiny).count()
    table = "pages" if name == "op6_url_filter" else "documents"
    assert n == spark.read.parquet(f"{tiny}/{table}.parquet").count()


def brute_pipeline(spark, rows):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for d, t, s in rows:
        last[t] = max(last.get(t, d), d)
    rows = [r for r in rows if last[r[1]] == r[0]]
    component = C.near_components([(d, t) for d, t, _ in rows])
    rows = [r for r in rows if component[r[0]][1] == r[0]]
    size, _, taken = C.mixed_words(rows, C.draws(spark, rows), mixing.SLOTS_PER_SOURCE, mixing.BLOCK_WORDS)
    copies = [int(taken[i] / size[i] + 0.5) if size[i] else 0 for i in range(len(rows))]
    for source in {r[2] for r in rows}:  # one document stays of each source that gives words
        own = [i for i, r in enumerate(rows) if r[2] == source]
        if not any(copies[i] for i in own) and any(taken[i] for i in own):
            copies[max(own, key=lambda i: (taken[i], -rows[i][0]))] = 1
    tokenizer, out = Tokenizer.from_file(WORD_BPE), []
    for i, (d, t, _) in enumerate(rows):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        out += [(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(text.encode()).hexdigest())] * copies[i]
    return sorted(out)


def test_pipeline(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert sorted(map(tuple, P.run(spark, tiny).collect())) == brute_pipeline(spark, rows)


def test_stages_return_columns_and_stand_odd_rows(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(60).unionByName(
        C.frame(spark, C.ODD))
    for name, function in P.STAGES[:-1]:
        out = function(spark, docs, tiny)
        assert out.columns == docs.columns and out.schema == docs.schema
        assert function(spark, docs.limit(0), tiny).count() == 0
        rows = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in out.collect()} <= rows
    assert P.STAGES[-1][1](spark, docs, tiny).count() == docs.count()


def test_clean_documents_stay(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("length(text) > 200")
    assert P.with_language(spark, docs, tiny).count() == docs.count()
