"""Byte-pair encoding and decoding with forced boundaries.

Two adjacent symbols that no vocabulary token holds side by side can never end up in one token.
A word is cut at every such place; its fragments are encoded on their own, and the ids joined.
Decoding puts tokens together as the tokenizer file's decoder says; a file without one separates
them by single spaces.

The file's normalizer and pre-tokenizer give the words of a chunk, and strings of added tokens
are taken out of the raw text first. Chunks between spaces (or line breaks, which the normalizer
makes spaces) are independent, because spaces never belong to a word here. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe_merge import ID_BITS, heap_merge, pair_table
from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.text_chunks import BYTE_LEVEL, LATIN, RecentCache

#: The word pattern whose result on chunks of Latin letters, digits and plain punctuation
#: ``_LATIN_WORDS`` gives as well.
_WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LATIN_CHUNK = re.compile(rf"[{LATIN}0-9!-&(-/:;=-@\[-`{{-~]+").fullmatch
_LATIN_WORDS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
_NORMAL = ["NFC", "Replace", "Lowercase"]

#: Chunks that a worker remembers, half as many words and a quarter as many
#: fragments: about 200 MB, which stay
#: beside whatever the same worker runs next. Results are the same for any number.
REMEMBERED = 600_000
#: Fragments up to this length are merged by scans, longer ones, of which a scan would take the
#: square of the length, with the heap. The result is the same.
SCAN_SYMBOLS = 32
_NONE = 1 << 62
_FIRST, _SECOND = itemgetter(0), itemgetter(1)
_ID = (1 << ID_BITS) - 1

CODEC_ROW = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def scan_merge(symbols: list[int], pairs: dict[int, int]) -> list[int]:
    """Merge the lowest-ranked pair, the leftmost of equal ones, until none is left."""
    get = pairs.get
    found = [get(a << ID_BITS | b, _NONE) for a, b in zip(symbols, symbols[1:])]
    while found:
        best = min(found)
        if best == _NONE:
            break
        at = found.index(best)
        merged = symbols[at] = best & _ID
        del symbols[at + 1], found[at]
        if at < len(found):
            found[at] = get(merged << ID_BITS | symbols[at + 1], _NONE)
        if at:
            found[at - 1] = get(symbols[at - 1] << ID_BITS | merged, _NONE)
    return symbols


class Codec:
    """Encoder and decoder for a byte-pair file with word ends and dropped white space."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        added = spec["added_tokens"]
        plain = (model["type"] == "BPE" and spec["decoder"] is None
                 and not model.get("ignore_merges") and not model.get("dropout")
                 and not model.get("continuing_subword_prefix"))
        if not plain or any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                            or t["normalized"] for t in added):
            raise ValueError(f"{path}: not a byte-pair tokenizer of this kind")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab = model["vocab"]
        self.pairs = pair_table(self.vocab, merges)
        self.inside = {pair for token in self.vocab for pair in self._pairs(token)}
        self.token = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in added}
        self.added = {t["content"]: t["id"] for t in added}
        self.added_strings = re.compile(
            "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        tokenizer = Tokenizer.from_file(path)
        normalizer, pre = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.normalize = normalizer.normalize_str if normalizer else str
        self.pre_tokenize = pre.pre_tokenize_str if pre else lambda text: [(text, None)]
        self.plain_words = (
            [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == _NORMAL
            and any(p.get("pattern") == {"Regex": _WORD_PATTERN}
                    for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []))
            and all("<" in content for content in self.added))
        probe = self.pre_tokenize("a b")
        if [piece for piece, _ in probe] != ["a", "b"]:
            raise ValueError(f"{path}: its words may hold spaces")
        self.fragments = RecentCache(self._encode_fragment, remembered // 4)
        self.words = RecentCache(self._encode_word, remembered // 2)
        self.chunks = RecentCache(self._encode_chunk, remembered)

    def _symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.end]

    def _pairs(self, token: str):
        ends = self.end and token.endswith(self.end) and token != self.end
        body = token[:-len(self.end)] if ends else token
        symbols = self._symbols(body) if ends else list(body)
        return zip(symbols, symbols[1:])

    def cut(self, word: str) -> list[tuple[str, ...]]:
        """The word's symbols, cut where two neighbours occur in no vocabulary token."""
        symbols, fragments, at = self._symbols(word), [], 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.inside:
                fragments.append(tuple(symbols[at:i]))
                at = i
        return [*fragments, tuple(symbols[at:])]

    def _encode_fragment(self, fragment: tuple[str, ...]) -> list[int]:
        symbols = [self.vocab[s] for s in fragment if s in self.vocab]
        if len(symbols) <= SCAN_SYMBOLS:
            return scan_merge(symbols, self.pairs)
        heap_merge(symbols, self.pairs)
        return [s for s in symbols if s >= 0]

    def _encode_word(self, word: str) -> list[int]:
        return [i for fragment in self.cut(word) for i in self.fragments[fragment]]

    def _encode_plain(self, text: str) -> list[int]:
        words = self.pre_tokenize(self.normalize(text)) if text else ()
        return [i for word, _ in words for i in self.words[word]]

    def encode(self, text: str) -> list[int]:
        """Ids of any text, added-token strings included."""
        ids, at = [], 0
        for hit in self.added_strings.finditer(text):
            ids += self._encode_plain(text[at:hit.start()])
            ids.append(self.added[hit[0]])
            at = hit.end()
        return ids + self._encode_plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids)

    def _encode_chunk(self, chunk: str) -> tuple[bytes, str]:
        """Packed ids, and the decoded tokens with a space before each."""
        if self.plain_words and _LATIN_CHUNK(chunk):
            ids = [i for word in _LATIN_WORDS(chunk.lower())
                   for i in self.words[word.translate(BYTE_LEVEL)]]
        else:
            ids = self.encode(chunk)
        return array("I", ids).tobytes(), f" {self.decode(ids)}" if ids else ""

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids (four little-endian bytes each) and of the decoded
        text."""
        chunks = text.replace("\n", " ").split(" ") if self.plain_words else text.split(" ")
        done = list(map(self.chunks.__getitem__, chunks))
        packed = b"".join(map(_FIRST, done))
        decoded = "".join(map(_SECOND, done))[1:]
        return (len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest())


@lru_cache(maxsize=2)
def codec(path: str, remembered: int = REMEMBERED) -> Codec:
    return Codec(path, remembered)


def encode_and_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                      text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ``remembered`` bounds the
    memory of a worker."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = codec(tokenizer, remembered).digests
        for batch in batches:
            done = [digests(t) for t in batch.column("text").to_pylist()]
            counts, ids, decoded = zip(*done) if done else ((), (), ())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, CODEC_ROW)


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, ids (array) and decoded text of every row."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            ids = [own.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([own.decode(i) for i in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return (id_and_text(docs, id_col, text_col)
            .mapInArrow(run, "doc_id long, ids array<int>, decoded string"))
