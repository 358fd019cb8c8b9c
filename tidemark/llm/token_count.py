"""Token counts without token ids: a piece of text has as many tokens as it has symbols at first,
less the merges that byte-pair merging makes in it.

The tokenizer file's own pre-tokenizer cuts a chunk into pieces, and the strings of its added
tokens count as one each. Counts of chunks are remembered (see ``text_chunks``), so that merging
runs once per distinct chunk and worker. Null texts count as empty ones, with no tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe_merge import heap_merge, pair_table
from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.text_chunks import (
    BYTE_LEVEL, LATIN, LINE_BREAK, PUNCTUATION, SPACE, RecentCache, chunks, single_spaced)

#: Latin letters and then plain punctuation: two pieces whose byte-level form is known.
_PLAIN = re.compile(rf"([{LATIN}]+)([{PUNCTUATION}]*)").fullmatch

COUNT_ROW = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """``count(text)`` for a byte-level byte-pair tokenizer file without a normalizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex") and not pre.get("add_prefix_space")
                 and spec["normalizer"] is None and spec["post_processor"] is None
                 and not model.get("ignore_merges") and not model.get("dropout")
                 and not model.get("end_of_word_suffix")
                 and not model.get("continuing_subword_prefix"))
        added = [t["content"] for t in spec["added_tokens"]]
        if not plain or any(" " in a for a in added) or any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level byte-pair tokenizer")
        self.pairs = pair_table(model["vocab"], merges)
        self.symbol = {s: i for s, i in model["vocab"].items() if len(s) == 1}
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))
                                or r"(?!)")
        self.piece_counts = RecentCache(self._count_piece)
        self.first = RecentCache(self._count_chunk)
        self.later = RecentCache(self._count_spaced)

    def _count_piece(self, piece: str) -> int:
        symbols = [self.symbol[c] for c in piece]
        return len(symbols) - heap_merge(symbols, self.pairs)

    def _count_chunk(self, chunk: str) -> int:
        total, at = 0, 0
        for hit in self.added.finditer(chunk):
            total += 1 + self._count_plain(chunk[at:hit.start()])
            at = hit.end()
        return total + self._count_plain(chunk[at:])

    def _count_spaced(self, chunk: str) -> int:
        plain = _PLAIN(chunk)
        if plain is not None:
            letters, marks = plain.groups()
            if not letters.isascii():
                letters = letters.translate(BYTE_LEVEL)
            return self.piece_counts[SPACE + letters] + (self.piece_counts[marks] if marks else 0)
        if "\n" in chunk and single_spaced(f" {chunk}."):  # a lone line break is a piece
            head, *lines = chunk.split("\n")
            return self.later[head] + sum(
                [self.piece_counts[LINE_BREAK] + (self.first[x] if x else 0) for x in lines])
        return self._count_chunk(" " + chunk)

    def _count_plain(self, text: str) -> int:
        return sum(self.piece_counts[piece] for piece, _ in self.pieces(text)) if text else 0

    def count(self, text: str) -> int:
        head, *rest = chunks(text)
        return self.first[head] + sum(map(self.later.__getitem__, rest))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [count(t) for t in texts]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, COUNT_ROW)
