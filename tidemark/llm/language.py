"""Language of a text: its family first, then the languages of that family against each other.

Features are hashed letter bigrams and trigrams of the whole lower-cased text, with everything
that is no letter as one gap. One linear support vector machine per family (against the rest)
picks the family; within it one machine per pair of languages votes, ties going to the larger
sum of margins and then to the smaller code. Families are a parameter; a language that the
table does not list is a family of its own.

Machines are fitted on the driver from a sample of labelled rows that is bounded by
``SAMPLE_ROWS``: equally many of every language, by the hash of id and text. Rows equal in both
count once, whatever their number. A language is learned unless ``SAMPLE_ROWS`` others have more
rows. Predictions run over all rows in tasks. A null text, or one without a letter, gives ``und``
and score 0; so does every text where no row is labelled. Text is the only input of a prediction.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Collection, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import prepared

#: Rows that the machines are fitted on, at most, over all languages.
SAMPLE_ROWS = 3000
FEATURES = 1 << 12
#: Machines that are fitted together.
AT_ONCE = 256
DRAWS = 1 << 30
UNKNOWN = "und"

#: ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "es fr it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "indic": "hi bn ur pa mr gu ne si",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz ky tk",
    "austronesian": "id ms tl jv mg",
    "dravidian": "ta te kn ml",
}

_LETTER = re.compile(r"[^\W\d_]")
_GAP = 32
_PAIR, _TRIPLE = np.uint32(2654435761), np.uint32(2246822519)
_SHIFT = np.uint32(32 - FEATURES.bit_length() + 1)


def family_table(families: dict[str, str] = FAMILIES) -> dict[str, str]:
    return {code: name for name, codes in families.items() for code in codes.split()}


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows whose id, as text, has a CRC-32 of remainder 1 by 3; a null id is not."""
    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """What a code point below 65,536 becomes: itself if it is a letter, else the gap."""
    return np.array([c if chr(c).isalpha() else _GAP for c in range(1 << 16)], np.uint32)


def features(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters()
    plain = codes < len(table)
    if plain.all():
        codes = table[codes]
    else:
        codes = np.where(plain, table[np.where(plain, codes, 0)], codes)
    gap = codes == _GAP
    codes = codes[~(gap & np.concatenate([[True], gap[:-1]]))] if len(codes) else codes
    codes = np.concatenate([[_GAP], codes, [_GAP]]).astype(np.uint32)
    pairs = codes[:-1] * _PAIR ^ codes[1:] * _TRIPLE
    triples = (pairs[:-1] * _PAIR + codes[2:]) * _TRIPLE
    counts = np.bincount((pairs * _PAIR) >> _SHIFT, minlength=FEATURES).astype(np.float32)
    counts += np.bincount(triples >> _SHIFT, minlength=FEATURES)
    counts = np.sqrt(counts)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def fit_machines(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Weights and bias, one row per column of ``y`` (labels -1 and 1), of linear machines with
    squared hinge loss, both classes weighing the same, by accelerated gradient steps."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    y = y.astype(x.dtype)
    positive = y > 0
    share = np.where(positive, 0.5 / np.maximum(positive.sum(axis=0), 1),
                     0.5 / np.maximum((~positive).sum(axis=0), 1)).astype(x.dtype)
    w = ahead = np.zeros((x.shape[1], y.shape[1]), x.dtype)
    rate, t = 1 / (2 * 2 + penalty), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        grad = -2 * (x.T @ (share * y * slack)) + penalty * ahead
        new, t_new = ahead - rate * grad, (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w.T


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, str]):
        self.langs = sorted(set(langs))
        of = [families.get(lang, lang) for lang in langs]
        self.families = sorted(set(of))
        self.members = {f: [c for c in self.langs if families.get(c, c) == f]
                        for f in self.families}
        y, z = np.array(of), np.array(langs)
        self.family_weights = np.concatenate(
            [fit_machines(x, np.where(y[:, None] == np.array(self.families[at:at + AT_ONCE]), 1, -1))
             for at in range(0, len(self.families), AT_ONCE)]) if len(self.families) > 1 else None
        self.duels, rows = [], []
        for family in self.families:
            for a, b in combinations(self.members[family], 2):
                pick = (z == a) | (z == b)
                self.duels.append((family, a, b))
                rows.append(fit_machines(x[pick], np.where(z[pick] == a, 1, -1)[:, None])[0])
        self.duel_weights = np.stack(rows) if rows else None

    @staticmethod
    def _margins(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ weights[:, :-1].T + weights[:, -1]

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        n = len(x)
        first = np.zeros(n, int)
        sure = np.ones(n)
        if self.family_weights is not None:
            margins = self._margins(self.family_weights, x)
            first = margins.argmax(axis=1)
            best = np.sort(margins, axis=1)
            sure = 1 / (1 + np.exp(-(best[:, -1] - best[:, -2])))
        duels = self._margins(self.duel_weights, x) if self.duels else np.zeros((n, 0))
        return [self._within(self.families[f], row, s) for f, row, s in zip(first, duels, sure)]

    def _within(self, family: str, margins: np.ndarray, sure: float) -> tuple[str, float]:
        votes = {c: [0, 0.0, 0.0] for c in self.members[family]}
        for (of, a, b), margin in zip(self.duels, margins):
            if of == family:
                p = 1 / (1 + math.exp(-2 * float(margin)))
                for code, m, q in ((a, margin, p), (b, -margin, 1 - p)):
                    votes[code][0] += m > 0
                    votes[code][1] += float(m)
                    votes[code][2] += q
        code = min(votes, key=lambda c: (-votes[c][0], -votes[c][1], c))
        rivals = len(votes) - 1
        return code, float(sure) * (votes[code][2] / rivals if rivals else 1.0)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch(
            [batch.column("lang"), pa.array([r.astype(np.float16).tobytes() for r in rows],
                                            pa.binary())], names=["lang", "x"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = SAMPLE_ROWS, families: dict[str, str] = FAMILIES) -> LanguageModel | None:
    """Machines from a bounded sample of the labelled rows that are not held out."""
    prepared(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    labelled = docs.where(~held_out(id_col) & F.col(f"`{lang_col}`").isNotNull() & text.isNotNull()).select(
        F.col(f"`{lang_col}`").alias("lang"), text.alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`"), text, F.lit(17)), F.lit(DRAWS)).alias("draw"))
    counts = (labelled.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"), F.count("*").alias("rows"))
              .orderBy(F.desc("rows"), "lang").limit(rows).collect())
    if not counts:
        return None
    each = max(1, rows // len(counts))
    # twice what is wanted, so that no language comes short; then exactly that many
    shares = {r["lang"]: math.ceil(min(1.0, 2 * (each + 8) / max(r["n"], 1)) * DRAWS) for r in counts}
    share = F.try_element_at(F.from_json(F.lit(json.dumps(shares)), "map<string,long>"), F.col("lang"))
    drawn = (labelled.where(F.col("draw") < share)
             .groupBy("lang", "draw").agg(F.min("text").alias("text")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = (drawn.withColumn("place", place).where(F.col("place") <= each).select("lang", "text")
              .mapInArrow(_feature_rows, "lang string, x binary").collect())
    if not sample:
        return None
    sample = sorted((r["lang"], bytes(r["x"])) for r in sample)
    x = np.stack([np.frombuffer(v, np.float16) for _, v in sample]).astype(np.float32)
    return LanguageModel(x, [lang for lang, _ in sample], family_table(families))


def _predict(model: LanguageModel | None, batch: pa.RecordBatch) -> list[tuple[str, float]]:
    texts = batch.column("text").to_pylist()
    known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    out = [(UNKNOWN, 0.0)] * len(texts)
    if known and model is not None:
        for at in range(0, len(known), 256):
            part = known[at:at + 256]
            for i, found in zip(part, model.predict(np.stack([features(texts[i]) for i in part]))):
                out[i] = found
    return out


def predict_language(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _predict(model, batch)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    model = fit(docs, id_col, text_col, lang_col, rows)
    return predict_language(docs, model, id_col, text_col)


def accepted(docs: DataFrame, model: LanguageModel | None, text_col: str = "text",
             languages: Collection[str] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a language, and one of
    ``languages`` if given. Without a model every text with a letter stays if no languages are
    given; if some are, that is an error."""
    if model is None and languages is not None:
        raise ValueError("no labelled rows: languages cannot be told apart")
    prepared(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                keep = [bool(t and _LETTER.search(t)) for t in batch.column(at).to_pylist()]
            else:
                only = pa.record_batch([batch.column(at)], names=["text"])
                keep = [f[0] != UNKNOWN and (languages is None or f[0] in languages)
                        for f in _predict(model, only)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
