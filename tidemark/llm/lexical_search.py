"""Ranked lexical search over a K2-treap index: the best documents of every item.

A term is a maximal run of bytes that are digits, letters A-Z (taken as a-z) or not ASCII; terms
are 64-bit hashes. A document's impact for a term depends on how often it has the term and on its
length against all documents'; an item's score for a document sums impact times term weight.

The index is a table in the shared folder with one row per tile: up to ``TILE_DOCS`` documents,
or ``TILE_POINTS`` (document, term) points, that follow each other in one task, so that building
it shuffles nothing. Tasks hand tiles over compressed and files keep a row group for each, so that
neither a writer nor a reader holds more than one, whatever the number of tiles. A search runs the items over every tile by blocks of ``BLOCK_TERMS`` item
terms. A task carries each item's best documents from tile to tile and returns these alone, from
which the best of all tasks follow in two steps.

A null or empty text has no terms, counts nowhere and is never found. Rows that repeat a doc_id
are documents of their own; a null doc_id comes after all others of its score. Items that share an
item_id (null too) are one, with the terms of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from tidemark.llm.k2_treap import Treap
from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.words import spans, word_hashes_between
from tidemark.session import fresh_dir, stage

#: A term in the words of a regular expression, for SQL.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents and points of a tile, at most (a single document may have more points).
TILE_DOCS = 4096
TILE_POINTS = 1 << 19
#: Item terms that one search job holds, about.
BLOCK_TERMS = 200_000
#: Parts of an item's candidates that are ranked alone before they meet.
PARTS = 32

_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_ARRAYS = {"terms": np.int64, "row_of": np.int32, "frequency": np.int32, "steps": np.int32}
TILE = ("doc_ids array<long>, bits int, cells array<int>, masks binary, "
        + ", ".join(f"{name} binary" for name in _ARRAYS))
#: Else Parquet's writer looks at the size of a page or a row group after 100 rows first.
TILE_FILES = {"compression": "uncompressed", "parquet.block.row.count.limit": "1",
              "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
FOUND = "item_id long, doc_id long, score long"


def term_hashes(text: str) -> np.ndarray:
    return word_hashes_between(text.encode(), _GAP)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(spans(np.frombuffer(t.encode(), np.uint8), _GAP)[0])
                          for t in batch.column("text").to_pylist()], np.int64)
        yield pa.record_batch([pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())])],
                              names=["n", "l"])


def statistics(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats. ``docs``: doc_id, text."""
    row = docs.select("text").mapInArrow(_sizes, "n long, l long").agg(F.sum("n"), F.sum("l")).head()
    return int(row[0] or 0), int(row[1] or 0)


def _packed(values: bytes) -> bytes:
    """The number of bytes and then the bytes, compressed."""
    return len(values).to_bytes(8, "little") + pa.compress(values, "zstd", asbytes=True)


def _unpacked(cell: pa.BinaryScalar) -> pa.Buffer:
    stored = cell.as_buffer()
    size = int.from_bytes(stored.slice(0, 8).to_pybytes(), "little")
    return pa.decompress(stored.slice(8), size, "zstd")


def _tile(held: list[tuple]) -> dict:
    """Columns of one tile from (doc_id, length factor, terms, occurrences), shortest first."""
    held = sorted(held, key=lambda d: d[1])
    sizes = [len(d[2]) for d in held]
    terms, times = (np.concatenate([d[i] for d in held]) for i in (2, 3))
    columns = np.repeat(np.arange(len(held)), sizes)
    factor = np.repeat(np.array([d[1] for d in held], np.int64), sizes)
    times = times.astype(np.int64)
    impacts = 1_000_000_000 * times // (1000 * times + 20 * factor)
    made = Treap.build(terms, columns, impacts, len(held)).dump()
    return {"doc_ids": [d[0] for d in held],
            **{k: _packed(v.tobytes()) if k in _ARRAYS else v for k, v in made.items()},
            "masks": _packed(made["masks"])}


def _tiles(n_docs: int, n_terms: int):
    names = [part.split()[0] for part in TILE.split(", ")]

    def close(held: list[tuple]) -> pa.RecordBatch:
        tile = _tile(held)
        types = {"doc_ids": pa.list_(pa.int64()), "bits": pa.int32(), "cells": pa.list_(pa.int32())}
        return pa.record_batch([pa.array([tile[n]], types.get(n, pa.binary())) for n in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, points = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = term_hashes(text)
                if not len(words):
                    continue
                terms, times = np.unique(words, return_counts=True)
                held.append((doc_id, 50 + 50 * len(words) * n_docs // n_terms, terms, times))
                points += len(terms)
                if len(held) >= TILE_DOCS or points >= TILE_POINTS:
                    yield close(held)
                    held, points = [], 0
        if held:
            yield close(held)
    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                ) -> tuple[DataFrame, int]:
    """The index of ``docs``, written to the shared folder, and the number of its documents."""
    spark = prepared(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    n_docs, n_terms = statistics(texts)
    path = fresh_dir(spark, "k2-index")
    texts.mapInArrow(_tiles(n_docs, n_terms), TILE).write.options(**TILE_FILES).parquet(path)
    return spark.read.schema(TILE).parquet(path), n_docs


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id and term of every distinct term of the items."""
    prepared(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.unique(term_hashes(t)) for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(terms)), [len(t) for t in terms])))
            flat = np.concatenate([*terms, np.zeros(0, np.uint64)])
            yield pa.record_batch([ids, pa.array(flat.view(np.int64))], names=["item_id", "term"])

    return id_and_text(items, id_col, text_col).mapInArrow(run, "item_id long, term long").distinct()


def frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of ``terms`` (sorted) is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, n in zip(batch.column("terms"), batch.column("frequency")):
                own = np.frombuffer(_unpacked(own), np.int64).view(np.uint64)
                at = np.searchsorted(own, terms)
                at[at == len(own)] = 0
                total += np.where(own[at] == terms, np.frombuffer(_unpacked(n), np.int32)[at], 0)
        has = np.flatnonzero(total)
        yield pa.record_batch([pa.array(has), pa.array(total[has])], names=["at", "n"])

    counts = (index.select("terms", "frequency").mapInArrow(run, "at long, n long")
              .groupBy("at").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(len(terms), np.int64)
    for row in counts:
        out[row["at"]] = row["n"]
    return out


class Best:
    """The ``k`` best documents of an item, by score and then doc_id, null ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.none, self.ids = (np.zeros(0, t) for t in (np.int64, bool, np.int64))

    def offer(self, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        scores, none, ids = (np.concatenate(pair) for pair in
                             ((self.scores, scores), (self.none, none), (self.ids, ids)))
        order = np.lexsort((ids, none, -scores))[:self.k]
        self.scores, self.none, self.ids = scores[order], none[order], ids[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def _loaded(batch: pa.RecordBatch, row: int) -> tuple[Treap, np.ndarray, np.ndarray]:
    arrays = {name: np.frombuffer(_unpacked(batch.column(name)[row]), kind)
              for name, kind in _ARRAYS.items()}
    treap = Treap.load(bits=batch.column("bits")[row].as_py(), cells=batch.column("cells")[row].as_py(),
                       masks=_unpacked(batch.column("masks")[row]), **arrays)
    ids = batch.column("doc_ids")[row].values
    return treap, ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()


def _search(queries: list[tuple], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in batches:
            for row in range(batch.num_rows):
                treap, none, ids = _loaded(batch, row)
                for (_, terms, weights), top in zip(queries, best):
                    for columns, scores in treap.search(terms, weights, lambda: top.least):
                        top.offer(scores, none[columns], ids[columns])
        sizes = [len(b.scores) for b in best]
        if any(sizes):
            items = pa.array([q[0] for q in queries], pa.int64()).take(
                pa.array(np.repeat(np.arange(len(queries)), sizes)))
            docs = pa.array(np.concatenate([b.ids for b in best]),
                            mask=np.concatenate([b.none for b in best]))
            yield pa.record_batch([items, docs, pa.array(np.concatenate([b.scores for b in best]))],
                                  names=["item_id", "doc_id", "score"])
    return run


def _block(index: DataFrame, terms: DataFrame, n_docs: int, k: int) -> DataFrame:
    """The best documents, by task, of the items of one block of ``terms``."""
    held: dict[int | None, list[int]] = {}
    for row in terms.collect():
        held.setdefault(row["item_id"], []).append(row["term"])
    known = np.unique(np.array([t for own in held.values() for t in own], np.int64).view(np.uint64))
    found = frequencies(index, known)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in found],
                       np.int64)
    weights[found == 0] = 0
    queries = []
    for item in sorted(held, key=lambda i: (i is None, i)):
        own = np.sort(np.array(held[item], np.int64).view(np.uint64))
        own_weights = weights[np.searchsorted(known, own)]
        queries.append((item, own[own_weights > 0], own_weights[own_weights > 0]))
    return index.mapInArrow(_search(queries, k), FOUND)


def search(index: DataFrame, n_docs: int, terms: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item of ``terms``
    (see ``item_terms``)."""
    terms = stage(terms, "item-terms")
    blocks = -(-terms.count() // BLOCK_TERMS) or 1
    of = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = reduce(DataFrame.unionByName,
                   [_block(index, terms.where(of == b), n_docs, k) for b in range(blocks)])
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    first = W.partitionBy("item_id", "part").orderBy(*order)
    near = found.withColumn("part", part).withColumn("place", F.row_number().over(first)).where(
        F.col("place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Index ``docs`` and rank them for each of ``items``: item_id, rank, doc_id, score."""
    index, n_docs = build_index(docs, id_col, text_col)
    return search(index, n_docs, item_terms(items, item_col, item_text_col), k)


SQL = rf"""
    WITH split AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '{TERM}') AS w
      FROM documents WHERE text IS NOT NULL),
    held AS (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM split WHERE len(w) > 0),
    totals AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM held),
    lengths AS (SELECT r, doc_id, 100 - 50 + ((50 * n * nd) // l) AS m FROM held, totals),
    points AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM held) GROUP BY r, t),
    weights AS (
      SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM points, totals GROUP BY t),
    items AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '{TERM}')) AS t
      FROM benchmark),
    scored AS (
      SELECT item_id, points.r, any_value(doc_id) AS doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM items JOIN weights ON weights.t = items.t JOIN points ON points.t = items.t
      JOIN lengths ON lengths.r = points.r
      GROUP BY item_id, points.r),
    ranked AS (
      SELECT item_id, row_number() OVER (
               PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
