"""Exact duplicates by an extendible-hash index on shared files.

Keys are 64-bit hashes of whole texts. A directory over their leading bits starts with one
bucket; a bucket above its capacity splits, and the directory doubles when that bucket already
uses all of its bits. Every bucket is one range of keys with one owner task: it reads its
entries in key order, chains texts that share a key and compares their bytes. The index is a
table of one row per distinct text, one folder per bucket, in the shared folder.

Only rows of equal key and text within an Arrow batch are combined before the shuffle, which
bounds what a text with any number of copies sends to its owner. Documents meet their class by
an outer join on key and digest, whose hot partitions adaptive execution splits.

Null texts count as empty. Rows that repeat a doc_id with the same text share its verdict; a
row without doc_id never wins over one that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import id_and_text, prepared
from tidemark.session import fresh_dir

#: Bytes of text (with a fixed cost per row) that a bucket holds before it splits.
BUCKET_BYTES = 32 << 20
#: Leading key bits the directory may use: it has 65,536 entries at most.
DIRECTORY_BITS = 16
ROW_COST = 64

ENTRY = "bucket int, key long, text string, keep_id long, group_size long"
CLASS = "bucket int, key long, slot int, text_sha256 string, keep_id long, group_size long"


class Directory:
    """Bucket of every leading-bit pattern, grown by splitting overfull buckets."""

    def __init__(self, cells: dict[int, int], capacity: int, bits: int = DIRECTORY_BITS):
        load = np.zeros((1 << bits) + 1, np.int64)
        for cell, size in cells.items():
            load[cell + 1] = size
        self.before, self.bits = np.cumsum(load), bits
        self.depth, self.slots, self.buckets = 0, np.zeros(1, np.int32), 1
        pending = [(0, 0, 0)]  # bucket, its local depth, its bit pattern
        while pending:
            bucket, depth, pattern = pending.pop()
            if depth == bits or self._load(depth, pattern) <= capacity:
                continue
            if depth == self.depth:
                self.slots, self.depth = np.repeat(self.slots, 2), depth + 1
            upper, self.buckets = self.buckets, self.buckets + 1
            span = 1 << (self.depth - depth - 1)
            at = (2 * pattern + 1) * span
            self.slots[at:at + span] = upper
            pending += [(bucket, depth + 1, 2 * pattern), (upper, depth + 1, 2 * pattern + 1)]

    def _load(self, depth: int, pattern: int) -> int:
        span = 1 << (self.bits - depth)
        return int(self.before[(pattern + 1) * span] - self.before[pattern * span])

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        if self.depth == 0:
            return np.zeros(len(keys), np.int32)
        return self.slots[keys.view(np.uint64) >> np.uint64(64 - self.depth)]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))


def grow_directory(entries: DataFrame, capacity: int = BUCKET_BYTES,
                   bits: int = DIRECTORY_BITS) -> Directory:
    """The driver sees one number per leading-bit pattern, 2**bits at most."""
    size = F.sum(F.octet_length("text") + ROW_COST)
    cells = (entries.groupBy(F.shiftrightunsigned("key", 64 - bits).cast("int").alias("cell"))
             .agg(size.alias("size")).collect())
    return Directory({r["cell"]: r["size"] for r in cells}, capacity, bits)


def _entries(directory: Directory):
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = (pa.Table.from_batches([batch]).group_by(["key", "text"], use_threads=False)
                      .aggregate([("doc_id", "max"), ("doc_id", "count", pc.CountOptions("all"))])
                      .combine_chunks())
            for part in groups.to_batches():
                keys = part.column("key").to_numpy(zero_copy_only=False)
                yield pa.record_batch(
                    [pa.array(directory.bucket_of(keys), pa.int32()), part.column("key"),
                     part.column("text"), part.column("doc_id_max"), part.column("doc_id_count")],
                    names=["bucket", "key", "text", "keep_id", "group_size"])
    return combine


def _larger(a, b):
    return b if a is None or (b is not None and b > a) else a


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of equal texts from entries in (bucket, key) order.

    The chain of one key holds its distinct texts; more than one is a hash collision.
    """
    names = ["bucket", "key", "slot", "text_sha256", "keep_id", "group_size"]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), pa.int32(), pa.string(),
                                        pa.int64(), pa.int64()])))
    current, links, done = None, [], []

    def close():
        for slot, (text, keep, size) in enumerate(links):
            digest = hashlib.sha256(text.encode()).hexdigest()
            done.append((*current, slot, digest, keep, size))

    for batch in batches:
        for bucket, key, text, keep, size in zip(*(c.to_pylist() for c in batch.columns)):
            if (bucket, key) != current:
                close()
                current, links = (bucket, key), []
            for link in links:
                if link[0] == text:
                    link[1], link[2] = _larger(link[1], keep), link[2] + size
                    break
            else:
                links.append([text, keep, size])
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], schema=schema)
            done.clear()
    close()
    if done:
        yield pa.record_batch([pa.array(c) for c in zip(*done)], schema=schema)


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = BUCKET_BYTES, bits: int = DIRECTORY_BITS) -> DataFrame:
    """Write the index of ``docs`` below ``path``: one row per distinct text."""
    spark = prepared(docs.sparkSession)
    entries = keyed(docs, id_col, text_col)
    directory = grow_directory(entries, capacity, bits)
    owned = (entries.mapInArrow(_entries(directory), ENTRY)
             .repartitionById(directory.buckets, F.col("bucket"))
             .sortWithinPartitions("bucket", "key")
             .mapInArrow(chain, CLASS))
    owned.write.partitionBy("bucket").parquet(path)
    return spark.read.schema(CLASS).parquet(path)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = BUCKET_BYTES, bits: int = DIRECTORY_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    spark = docs.sparkSession
    index = build_index(docs, fresh_dir(spark, "exact-index"), id_col, text_col, capacity, bits)
    classes = index.where("group_size > 1").select(
        F.col("key").alias("class_key"), F.col("text_sha256").alias("class_sha"),
        "keep_id", "group_size")
    rows = keyed(docs, id_col, text_col).select(
        "doc_id", "key", F.sha2("text", 256).alias("text_sha256"))
    joined = rows.join(classes, (rows["key"] == classes["class_key"])
                       & (rows["text_sha256"] == classes["class_sha"]), "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
