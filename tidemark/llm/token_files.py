"""Token ids of a corpus in Arrow files of equal-length sequences.

A shard is one Arrow IPC file. Each record batch holds sequences of exactly ``length`` ids as a
fixed-size list, and a fixed-size list of bits that is true for real ids: only the last sequence
of a shard is padded. A memory map of the file gives any sequence as a view, by row number,
without reading or copying others. The schema's metadata holds the sequence length.
Ids take two bytes where the vocabulary allows, else four.

Documents are range-partitioned by id, so shard after shard, and row after row within one, they
are in ascending order. Document boundaries are a Parquet table beside the shards. Each task
writes its shard under a name of its own and returns the name as a row; the manifest written by
Spark lists the shards that count, so a file left by a lost or repeated task is never read.

Empty and null texts become the end id alone. Rows without doc_id come first; rows that repeat a
doc_id all are encoded, in an order fixed by their text.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.text_chunks import (
    BYTE_LEVEL, LATIN, LINE_BREAK, PUNCTUATION, SPACE, RecentCache, chunks, single_spaced)
from tidemark.session import fresh_dir

SEQUENCE = 1024
#: Chunks, and pieces, that a worker remembers: about 150 MB each.
CACHED = 800_000
#: Sequences per record batch.
BATCH = 256

SHARD_ROW = "shard int, doc_id long, local_start long, n_tokens long, file string"
DOC_ROW = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"

#: Latin letters and then plain punctuation: two pieces whose byte-level form is known.
_PLAIN = re.compile(rf"([{LATIN}]+)([{PUNCTUATION}]*)").fullmatch


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


class Encoder:
    """``bytes_of(text)``: the library's ids of a whole text, little-endian.

    ``by_chunks`` says that the file's pre-tokenizer keeps white space at the front of pieces
    only, as byte-level ones do; other files encode whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = id_type(self.tokenizer.get_vocab_size(True))
        code = "H" if self.dtype.itemsize == 2 else "I"
        assert array(code).itemsize == self.dtype.itemsize and sys.byteorder == "little"
        self.pack = lambda ids: array(code, ids).tobytes()
        pre = str(self.tokenizer.pre_tokenizer)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_chunks = (pre.startswith("ByteLevel(add_prefix_space=False")
                          and "use_regex=True" in pre and self.tokenizer.normalizer is None
                          and not any(" " in s or s.isalpha() for s in special))
        self.tokenize = self.tokenizer.model.tokenize
        self.pieces = RecentCache(self._encode_piece, CACHED)
        self.first = RecentCache(self._encode_first)
        self.later = RecentCache(self._encode_later, CACHED)

    def _encode(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _encode_piece(self, piece: str) -> bytes:
        """A piece of which the byte-level form is known, without another pre-tokenization."""
        return self.pack([t.id for t in self.tokenize(piece)])

    def _encode_plain(self, letters: str, marks: str, space: str = "") -> bytes:
        if not letters.isascii():
            letters = letters.translate(BYTE_LEVEL)
        return self.pieces[space + letters] + (self.pieces[marks] if marks else b"")

    def _encode_first(self, chunk: str) -> bytes:
        plain = _PLAIN(chunk)
        if plain is None:
            return self._encode(chunk)
        return self._encode_plain(*plain.groups())

    def _encode_later(self, chunk: str) -> bytes:
        plain = _PLAIN(chunk)
        if plain is not None:
            return self._encode_plain(*plain.groups(), SPACE)
        if "\n" in chunk and single_spaced(f" {chunk}."):  # a lone line break is a piece
            head, *lines = chunk.split("\n")
            return self.later[head] + b"".join(
                [x for line in lines for x in (self.pieces[LINE_BREAK], self.first[line] if line else b"")])
        return self._encode(" " + chunk)

    def bytes_of(self, text: str) -> bytes:
        if not self.by_chunks:
            return self._encode(text)
        head, *rest = chunks(text)
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def file_schema(dtype: np.dtype, length: int) -> pa.Schema:
    kind = pa.from_numpy_dtype(dtype)
    return pa.schema([pa.field("ids", pa.list_(kind, length)),
                      pa.field("mask", pa.list_(pa.bool_(), length))],
                     metadata={b"sequence_length": str(length).encode()})


class ShardWriter:
    """Collects ids and writes full batches; holds at most one batch and one document."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.schema, self.dtype, self.length = file_schema(dtype, length), dtype, length
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held, self.n_held = [], 0

    def _write(self, ids: np.ndarray, n_real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < n_real)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                 pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        full = self.length * BATCH
        if self.n_held >= full:
            flat = np.concatenate(self.held)
            cut = len(flat) // full * full
            for at in range(0, cut, full):
                self._write(flat[at:at + full], full)
            self.held, self.n_held = [flat[cut:].copy()], len(flat) - cut

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.dtype)
            padded[:len(flat)] = flat
            self._write(padded, len(flat))
        self.writer.close()


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:")
                                    else f"file://{uri}")


def _encode_shards(folder: str, tokenizer: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, local, writer, sink = TaskContext.get().partitionId(), 0, None, None
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype)
        file = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            if writer is None:
                fs, path = _filesystem(file)
                sink = fs.open_output_stream(path)
                writer = ShardWriter(sink, enc.dtype, length)
            starts, counts = [], []
            for text in batch.column("text").to_pylist():
                ids = np.concatenate([np.frombuffer(enc.bytes_of(text), enc.dtype), end])
                writer.add(ids)
                starts.append(local)
                counts.append(len(ids))
                local += len(ids)
            n = batch.num_rows
            yield pa.record_batch(
                [pa.array([shard] * n, pa.int32()), batch.column("doc_id"),
                 pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([file] * n)],
                names=["shard", "doc_id", "local_start", "n_tokens", "file"])
        if writer is not None:
            writer.close()
            sink.close()
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                      length: int = SEQUENCE, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode ``docs`` into shards and the table of boundaries below ``folder``.

    ``folder`` is a path or URI that all executors reach and that pyarrow can open.
    """
    spark = prepared(docs.sparkSession)
    _make_dir(f"{folder}/shards")
    ordered = (id_and_text(docs, id_col, text_col)
               .repartitionByRange(_parts(spark), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    rows = ordered.mapInArrow(_encode_shards(f"{folder}/shards", tokenizer, end_id, length),
                              SHARD_ROW)
    rows.write.parquet(f"{folder}/boundaries")


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _make_dir(uri: str) -> None:
    fs, path = _filesystem(uri)
    fs.create_dir(path, recursive=True)


class TokenFile:
    """Random access to one shard by sequence number or by id range.

    On a local or mounted file system the file is memory-mapped and sequences are views.
    """

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.reader = pa.ipc.open_file(pa.memory_map(path) if local else fs.open_input_file(path))
        self.length = int(self.reader.schema.metadata[b"sequence_length"])
        self._batch: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _get(self, number: int) -> pa.RecordBatch:
        if self._batch[0] != number:
            self._batch = number, self.reader.get_batch(number)
        return self._batch[1]

    def sequence(self, row: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one sequence."""
        batch = self._get(row // BATCH)
        at = row % BATCH
        return (self._flat(batch)[at * self.length:(at + 1) * self.length],
                batch.column(1)[at].values)

    @staticmethod
    def _flat(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=True)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the shard."""
        full, parts = self.length * BATCH, []
        while count > 0:
            flat = self._flat(self._get(start // full))
            at = start % full
            parts.append(flat[at:at + count])
            start, count = start + len(parts[-1]), count - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, np.uint16)])


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, file = None, None
    for batch in batches:
        crc = []
        columns = [batch.column(c).to_pylist() for c in ("file", "local_start", "n_tokens")]
        for path, start, count in zip(*columns):
            if path != name:
                name, file = path, TokenFile(path)
            crc.append(zlib.crc32(file.ids(start, count).astype("<u4").tobytes()))
        yield pa.record_batch(
            [batch.column("shard"), batch.column("doc_id"), batch.column("local_start"),
             batch.column("n_tokens"), pa.array(crc, pa.int64())],
            names=["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    The driver sees one count per shard, from which the shards' offsets follow.
    """
    rows = prepared(spark).read.schema(SHARD_ROW).parquet(f"{folder}/boundaries")
    totals = sorted((r["shard"], r["n"]) for r in
                    rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    offsets, total = [], 0
    for shard, n in totals:
        offsets.append((shard, total))
        total += n
    shards = spark.createDataFrame(offsets, "shard int, shard_start long")
    read = rows.mapInArrow(_read_shards, DOC_ROW)
    return (read.join(shards, "shard")
            .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = SEQUENCE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back."""
    folder = fresh_dir(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id, length, id_col, text_col)
    return read_token_files(docs.sparkSession, folder)
