"""License notices in texts: winnowed fingerprints find candidates, banded alignment measures.

Templates and texts are cut into words (ASCII letters and digits and all other characters beyond
ASCII; A-Z as a-z). Of the hashes of consecutive ``GRAM`` words, winnowing keeps the smallest of
each ``WINDOW`` neighbours, so a run of GRAM + WINDOW - 1 equal words shares a fingerprint. An
inverted index of the templates' fingerprints (template, place) gives candidates: hits of one
template on nearby diagonals. Templates of at most ``SHORT`` words are indexed, and looked up, by
all of their grams: in them two equal words in a row always meet.

A longer template needs one hit for every ``SPARSE`` of its words. Where a share of 0.8 of its words
is left by changing or leaving out words, at least a fifteenth of them head runs that share a
fingerprint, so that none of those is lost; what words put in between break up further may be.

Around the middle of each candidate, a local alignment inside a band of diagonals scores equal words
against missing, added and changed ones. Of occurrences whose spans overlap, the one with the most
matched words, less missing ones and foreign ones in its span, is reported, so that a notice is not
taken for its neighbour; then that with the smaller name.

Templates are a parameter, by default the notices of ``license_notices.json``; their index goes to
every task and is bounded by ``MAX_TEMPLATE_WORDS``. Texts are read whole. A null text, or one
without words, matches nothing.
"""

from __future__ import annotations

import json
import pkgutil
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.words import hashed_words, mix

GRAM = 2
WINDOW = 3
#: Words of a template that is indexed by all of its grams.
SHORT = 24
#: Words of a longer template per hit that a candidate must have.
SPARSE = 15
#: Diagonals to each side of a candidate's that the alignment may use.
BAND = 8
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 200_000

#: Notices as they are published, by licence.
TEMPLATES: dict[str, str] = json.loads(pkgutil.get_data(__package__, "license_notices.json"))

MATCH_ROW = ("doc_id long, license string, coverage double, n_matched int, start int, end int, "
             "spans array<struct<start:int,end:int>>")

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def gram_hashes(hashes: np.ndarray, width: int = GRAM) -> np.ndarray:
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = (total ^ hashes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(total)


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the fingerprints: in each window the smallest hash, the last of equal ones.
    Fewer grams than a window are one window."""
    if not len(grams):
        return np.zeros(0, np.int64)
    window = min(window, len(grams))
    n = len(grams) - window + 1
    best, at = grams[:n].copy(), np.arange(n)
    for i in range(1, window):
        later = grams[i:i + n]
        take = later <= best
        best[take] = later[take]
        at[take] = np.flatnonzero(take) + i
    return np.unique(at)


class TemplateIndex:
    """Templates as word hashes, and the inverted index of their fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.words, self.least = {}, {}
        postings, short = defaultdict(list), set()
        for name, text in templates.items():
            hashes = hashed_words(text.encode(), True, _GAP)[0]
            self.words[name] = hashes
            grams = gram_hashes(hashes)
            whole = len(hashes) <= SHORT
            self.least[name] = 1 if whole else len(hashes) // SPARSE
            for at in range(len(grams)) if whole else winnow(grams):
                postings[int(grams[at])].append((name, int(at)))
                if whole:
                    short.add(int(grams[at]))
        if sum(map(len, self.words.values())) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words of templates")
        self.postings = dict(postings)
        self.keys = np.array(sorted(self.postings), np.uint64)
        self.short = np.array(sorted(short), np.uint64)
        self.tall = {n for n, words in self.words.items() if len(words) > SHORT}

    def hits(self, hashes: np.ndarray) -> dict[str, list[tuple[int, int]]]:
        """(place in the text, place in the template) of common fingerprints, by template: of
        all grams for short templates, of those that winnowing keeps for the others."""
        found = defaultdict(list)
        grams = gram_hashes(hashes)
        kept = winnow(grams)
        known = np.isin(grams, self.short)
        known[kept] |= np.isin(grams[kept], self.keys)
        sparse = set(kept[known[kept]].tolist())
        for i in np.flatnonzero(known).tolist():
            for name, place in self.postings[int(grams[i])]:
                if name not in self.tall or i in sparse:
                    found[name].append((i, place))
        return found


def align(text: np.ndarray, template: np.ndarray, diagonal: int, low: int, high: int,
          band: int = BAND) -> tuple[int, list[tuple[int, int]]]:
    """Best local alignment of ``template`` with ``text[low:high]`` on diagonals (text place
    less template place) within ``band`` of ``diagonal``: matched words, and the spans of text
    words that are matched one after the other. A match scores 2, any difference -1; of equal
    alignments the one that ends nearest to ``diagonal``, and of these the first, counts.

    The band is kept row by row, one row per template word; steps inside a row (words of the text
    alone) are a running maximum.
    """
    width, rows = 2 * band + 1, len(template)
    offset = np.arange(width)
    places = offset[None, :] + np.arange(rows)[:, None] + diagonal - band
    inside = (places >= low) & (places < high)
    equal = np.zeros((rows, width), bool)
    equal[inside] = np.repeat(template, width).reshape(rows, width)[inside] == text[places[inside]]
    gain = np.where(equal, 2, -1)
    score = np.zeros((rows + 1, width + 1), np.int64)
    for i in range(rows):
        row = np.maximum(score[i, :-1] + gain[i], score[i, 1:] - 1)
        row = np.where(inside[i], np.maximum(row, 0), -1 << 40)
        row = np.maximum.accumulate(row + offset) - offset
        score[i + 1, :-1] = np.where(inside[i], np.maximum(row, 0), 0)
    best = int(score.max())
    matched, found = 0, []
    if best > 0:
        ends = np.argwhere(score == best)
        i, k = min(ends.tolist(), key=lambda at: (abs(at[1] - band), at[0], at[1]))
        while i and score[i, k] > 0:
            if score[i, k] == score[i - 1, k] + gain[i - 1, k]:
                if equal[i - 1, k]:
                    matched += 1
                    found.append(int(places[i - 1, k]))
                i -= 1
            elif score[i, k] == score[i - 1, k + 1] - 1:
                i, k = i - 1, k + 1
            else:
                k -= 1
    spans: list[tuple[int, int]] = []
    for j in reversed(found):
        if spans and spans[-1][1] == j:
            spans[-1] = (spans[-1][0], j + 1)
        else:
            spans.append((j, j + 1))
    return matched, spans


def candidates(hits: list[tuple[int, int]], length: int, least: int = 1, band: int = BAND):
    """Groups of at least ``least`` hits on nearby diagonals and at nearby places, each as
    (diagonal, low, high)."""
    groups: list[list[tuple[int, int]]] = []
    for at, place in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        last = groups[-1][-1] if groups else None
        if last and abs((at - place) - (groups[-1][0][0] - groups[-1][0][1])) <= band // 2 \
                and at - last[0] <= length + band:
            groups[-1].append((at, place))
        else:
            groups.append([(at, place)])
    for group in groups:
        if len(group) < least:
            continue
        diagonals = sorted(at - place for at, place in group)
        diagonal = diagonals[len(diagonals) // 2]
        yield diagonal, max(0, diagonal - band), diagonal + length + band


def scan(text: str, index: TemplateIndex, min_coverage: float = MIN_COVERAGE) -> list[tuple]:
    """(license, coverage, matched words, first and end character, character spans) of every
    occurrence, in text order; of overlapping ones the best counts."""
    raw, found = text.encode(), []
    hashes, first, last = hashed_words(raw, True, _GAP)
    for name, hits in index.hits(hashes).items():
        template = index.words[name]
        for diagonal, low, high in set(candidates(hits, len(template), index.least[name])):
            matched, spans = align(hashes, template, diagonal, low, min(high, len(hashes)))
            coverage = matched / len(template)
            if spans and coverage >= min_coverage:
                start, end = spans[0][0], spans[-1][1]
                worth = matched - (len(template) - matched) - (end - start - matched)
                found.append((-worth, -matched, name, start, end, coverage, spans))
    used: list[tuple[int, int]] = []
    out = []
    for _, less, name, start, end, coverage, spans in sorted(found, key=lambda f: f[:5]):
        if all(end <= a or start >= b for a, b in used):
            used.append((start, end))
            where = _characters(raw, [(first[a], last[b - 1]) for a, b in spans])
            out.append((name, coverage, -less, where[0][0], where[-1][1], where))
    return sorted(out, key=lambda m: (m[3], m[0]))


def _characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans, in order, as character spans."""
    out, at, chars = [], 0, 0
    for span in spans:
        ends = []
        for end in span:
            chars += len(raw[at:end].decode())
            at = end
            ends.append(chars)
        out.append(tuple(ends))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
                  min_coverage: float = MIN_COVERAGE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per occurrence of a template in a row of ``docs`` (see ``scan``)."""
    prepared(docs.sparkSession)
    index = TemplateIndex(templates)
    types = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()),
                       ("n_matched", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                       ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *match) for doc, text in zip(batch.column("doc_id").to_pylist(),
                                                       batch.column("text").to_pylist())
                    for match in scan(text, index, min_coverage)]
            spans = [[{"start": a, "end": b} for a, b in r[6]] for r in rows]
            columns = [pa.array([r[i] for r in rows], types.field(i).type) for i in range(6)]
            yield pa.record_batch([*columns, pa.array(spans, types.field(6).type)], schema=types)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, MATCH_ROW)


def license_coverage(docs: DataFrame, templates: dict[str, str] = TEMPLATES,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``scan_licenses`` with the spans as text, ``12-40 44-60``."""
    found = scan_licenses(docs, templates, id_col=id_col, text_col=text_col)
    span = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return found.withColumn("spans", F.array_join(span, " "))
