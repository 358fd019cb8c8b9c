"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression.

Features count, per word or per character, hits of two lexicons (a fixed list of insults in four
languages, and words and stems learned from labels), hits that show only once obfuscation is
undone, how close a hit is to a word of the second person, capitals, and marks of punctuation and
obfuscation.
The trees and the calibration are Spark's; the features of a text are one pass in Python.

Everything is learned from at most ``SAMPLE_ROWS`` labelled rows that are not held out, drawn by
the hash of their id, each class up to half of them; weights restore the true shares. They fall
into three folds by another hash: one gives the lexicon, one fits the trees, one calibrates them.

Of rows that share a doc_id, the largest text is learned from; of several labels, toxic wins. A
label above 0 is toxic, a null one none. Without labelled rows of both classes in the folds that
need them, every text has the same score: the share of toxic ones among labelled rows, with one
row of each class added (0.5 without any). A null text counts as empty. Labels, language, source
and id are never inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.language import held_out
from tidemark.llm.tables import id_and_text, prepared
from tidemark.session import stage

#: Labelled rows that are learned from, at most.
SAMPLE_ROWS = 24_000
#: Learned words and stems (first letters of longer words, written with an asterisk), at most.
LEXICON_ENTRIES = 400
STEMS = range(3, 9)
#: Least distance from chance of an entry, in standard errors.
LEXICON_SURE = 3.5
TOXIC_AT = 0.7
TREES, DEPTH, STEP = 20, 4, 0.3
SEED = 13

#: Insults by language. A parameter of ``feature_maker``.
INSULTS = {
    "en": "idiot idiots idiotic moron morons moronic stupid dumb dumbass fool imbecile cretin loser "
          "losers pathetic worthless useless trash garbage scum scumbag vermin clown clowns jerk "
          "bastard asshole bitch disgusting filthy filth creep coward liar pig shit bullshit fuck "
          "fucking crap retard retarded ugly hate",
    "es": "idiota idiotas imbécil estúpido estúpida tonto tonta basura asco asqueroso asquerosa "
          "patético patética inútil payaso payasa cabrón mierda puta gilipollas maldito cobarde cerdo",
    "fr": "idiot idiote imbécile stupide crétin crétine débile abruti abrutie ordure connard connasse "
          "merde putain salaud salope pathétique minable clown dégoûtant lâche nul nulle",
    "de": "idiot idiotin dumm dummkopf blöd blödmann trottel arschloch scheiße abschaum müll versager "
          "versagerin erbärmlich wertlos widerlich ekelhaft clown feigling schwein drecksau hurensohn",
}

#: Words of the second person by language.
SECOND_PERSON = {
    "en": "you your yours yourself u ur ya youre",
    "es": "tú tu tus ti te usted ustedes vosotros vuestro",
    "fr": "tu toi ton ta tes vous votre vos",
    "de": "du dich dir dein deine deinen euch euer ihr",
}

#: Marks written for letters.
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")

FEATURES = ("words", "insults", "insult_count", "distinct_insults", "learned", "learned_count",
            "learned_most", "hidden", "second_person", "near_mean", "near_most", "capitals",
            "capital_words", "exclaims", "asks", "runs_of_marks", "odd_words", "stretched", "spaced")
LEARNED = "doc_id long, text string, toxic int, weight double, fold int"

_WORD = re.compile(r"[^\W_]+")
_ODD = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[013457@$!|*]++[^\W\d_]++)+|[@$][^\W\d_]{2,}+")
_MARKS = re.compile(r"[!?]{2,}")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
_GAPS = re.compile(r"[\W_]+")


_OTHER, _LETTER, _CAPITAL, _MARK, _RARE = range(5)
#: Separators below 128 as spaces, for texts without any other separators.
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """What a code point below 65,536 is: letter, capital, a mark that is written for a letter, a
    separator above 127, or something else."""
    def kind(c: int) -> int:
        if chr(c).isalpha():
            return _CAPITAL if chr(c).isupper() else _LETTER
        if chr(c) in "013457@$!|*":
            return _MARK
        return _RARE if c > 127 and not chr(c).isalnum() else _OTHER
    return np.array([kind(c) for c in range(1 << 16)], np.uint8)


def _kinds_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points and their kinds; those above 65,535 count as separators."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[np.minimum(codes, 0xFFFF)]
    if len(codes) and codes.max() > 0xFFFF:
        kinds[codes > 0xFFFF] = _RARE
    return codes, kinds


def _capital_words(kinds: np.ndarray) -> int:
    """Runs of two letters or more that are capitals throughout."""
    letter = (kinds == _LETTER) | (kinds == _CAPITAL)
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    capitals = np.concatenate([[0], np.cumsum(kinds == _CAPITAL)])
    return int(((end - start >= 2) & (capitals[end] - capitals[start] == end - start)).sum())


def _words(lists: dict[str, str]) -> frozenset[str]:
    return frozenset(w for text in lists.values() for w in text.split())


def entries(words: Iterable[str]) -> set[str]:
    """The words and their stems."""
    found = set(words)
    return found | {f"{w[:k]}*" for w in found for k in STEMS if k < len(w)}


class FeatureMaker:
    """Dense features of a text, in the order of ``FEATURES``."""

    def __init__(self, learned: dict[str, float], insults: dict[str, str] = INSULTS,
                 second_person: dict[str, str] = SECOND_PERSON):
        self.learned, self.insults, self.you = learned, _words(insults), _words(second_person)
        self.heads = {e[:STEMS[0]] for e in learned if e.endswith("*")}

    def weight(self, word: str) -> float:
        """The largest weight of a learned entry that the word has, 0 without one."""
        found = self.learned.get(word, 0.0)
        if word[:STEMS[0]] in self.heads:
            found = max(found, *(self.learned.get(f"{word[:k]}*", 0.0) for k in STEMS if k < len(word)), 0.0)
        return found

    def bad(self, word: str) -> bool:
        return word in self.insults or self.weight(word) > 0

    def hidden(self, odd: list[str], spaced: list[str], stretched: list[str], words: list[str]) -> int:
        """Words that are in a lexicon only once obfuscation is undone."""
        found = sum(self.bad(w.translate(LOOKALIKE).replace("*", "")) or self._starred(w) for w in odd)
        found += sum(self.bad(_GAPS.sub("", run)) for run in spaced)
        if stretched:
            for word in words:
                if _LONG.search(word) and not self.bad(word):
                    found += self.bad(_LONG.sub(r"\1", word)) or self.bad(_LONG.sub(r"\1\1", word))
        return found

    def _starred(self, odd: str) -> bool:
        if "*" not in odd:
            return False
        plain = odd.translate(LOOKALIKE)
        return any(len(w) == len(plain) and all(c in ("*", d) for c, d in zip(plain, w))
                   for w in self.insults)

    def __call__(self, text: str) -> list[float]:
        lower = text.lower()
        _, original = _kinds_of(text)
        codes, kinds = _kinds_of(lower)
        seen = np.bincount(kinds, minlength=5)
        words = (_WORD.findall(lower) if seen[_RARE] else
                 lower.encode("utf-8", "surrogatepass").translate(_PLAIN).decode("utf-8", "surrogatepass").split())
        letter = (kinds == _LETTER) | (kinds == _CAPITAL)
        alone = letter.copy()
        alone[1:] &= ~letter[:-1]
        alone[:-1] &= ~letter[1:]
        thrice = (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]) & letter[2:]
        odd = _ODD.findall(lower) if seen[_MARK] else []
        spaced = _SPACED.findall(lower) if alone.sum() > 3 else []
        stretched = _LONG.findall(lower) if thrice.any() else []
        exclaims, asks = text.count("!"), text.count("?")
        runs = len(_MARKS.findall(text)) if exclaims + asks > 1 else 0
        capitals = int((original == _CAPITAL).sum())
        letters = capitals + int((original == _LETTER).sum())
        n = max(len(words), 1)
        chars = max(len(text), 1)
        weights = {w: self.weight(w) for w in set(words)
                   if w in self.insults or w in self.learned or w[:STEMS[0]] in self.heads}
        hits = [i for i, w in enumerate(words)
                if w in weights and (weights[w] or w in self.insults)] if weights else []
        own = [weights[words[i]] for i in hits if weights[words[i]]]
        insults = sum(words[i] in self.insults for i in hits)
        distinct = len(self.insults.intersection(weights))
        you = 0
        near_mean = near_most = 0.0
        if not self.you.isdisjoint(words):
            addressed = np.array([i for i, w in enumerate(words) if w in self.you])
            you = len(addressed)
            if hits:
                at = np.array(hits)
                after = np.clip(np.searchsorted(addressed, at), 0, you - 1)
                gap = np.minimum(abs(addressed[after] - at), abs(addressed[np.maximum(after - 1, 0)] - at))
                near = 1 / (1 + gap)
                near_mean, near_most = float(near.mean()), float(near.max())
        return [float(np.log1p(len(words))), 100 * insults / n, float(np.log1p(insults)),
                float(distinct), 100 * sum(own) / n, float(np.log1p(len(own))), max(own, default=0.0),
                float(np.log1p(self.hidden(odd, spaced, stretched, words))), 100 * you / n, near_mean, near_most,
                capitals / max(letters, 1), (_capital_words(original) if capitals > 1 else 0) / n,
                100 * exclaims / chars, 100 * asks / chars, 100 * runs / n,
                100 * len(odd) / n, 100 * len(stretched) / n, 100 * len(spaced) / n]


def with_features(rows: DataFrame, maker: FeatureMaker) -> DataFrame:
    """``rows`` with ``features`` (an array of doubles) in the place of ``text``."""
    kept = [c for c in rows.columns if c != "text"]
    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [maker(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([*[batch.column(c) for c in kept],
                                   pa.array(found, pa.list_(pa.float64()))], names=[*kept, "features"])

    return rows.select(*kept, "text").mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_id_col: str = "doc_id", label_col: str = "toxic",
                    rows: int = SAMPLE_ROWS) -> tuple[DataFrame | None, float]:
    """doc_id, text, toxic, weight and fold of the rows to learn from (None without rows of both
    classes), and the share of toxic ones."""
    known = (labels.where(~held_out(label_id_col) & F.col(f"`{label_id_col}`").isNotNull()
                          & F.col(f"`{label_col}`").isNotNull())
             .groupBy(F.col(f"`{label_id_col}`").cast("long").alias("of"))
             .agg(F.max((F.col(f"`{label_col}`") > 0).cast("int")).alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return None, share

    def by_class(values: dict[int, float]) -> Column:
        return F.when(F.col("toxic") == 1, F.lit(values[1])).otherwise(F.lit(values[0]))

    part = {c: min(1.0, rows / 2 / n) for c, n in counts.items()}
    draw = F.pmod(F.xxhash64("of", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = (known.withColumn("draw", draw).where(F.col("draw") < by_class(part))
              .orderBy("draw", "of").limit(rows))
    texts = id_and_text(docs, id_col, text_col)
    met = (texts.join(chosen, texts["doc_id"] == chosen["of"])
           .groupBy("doc_id", "toxic").agg(F.max("text").alias("text")))
    fold = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(1), F.lit(2)),
                        (F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(4)) + 1).cast("int"))
    weight = by_class({c: 1 / p for c, p in part.items()})
    return stage(met.select("doc_id", "text", "toxic", weight.alias("weight"), fold.alias("fold")),
                 "toxic-sample"), share


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts.update((entry, toxic) for entry in entries(_WORD.findall(text.lower())))
        yield pa.record_batch([pa.array([e for e, _ in counts], pa.string()),
                               pa.array([t for _, t in counts], pa.int32()),
                               pa.array(counts.values(), pa.int64())], names=["entry", "toxic", "n"])


def learn_lexicon(sample: DataFrame, size: int = LEXICON_ENTRIES) -> dict[str, float]:
    """Entries that more toxic texts of ``sample`` have than others would, with their log odds."""
    sides = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sides.get(1, 0), sides.get(0, 0)
    if not toxic or not clean:
        return {}
    counts = (sample.select("text", "toxic").mapInArrow(_entry_counts, "entry string, toxic int, n long")
              .groupBy("entry").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
                                    F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c")))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    sure = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = (counts.select("entry", odds.alias("odds"), sure.alias("sure"))
            .where(F.col("sure") >= LEXICON_SURE).orderBy(F.desc("sure"), "entry").limit(size))
    return {r["entry"]: r["odds"] for r in best.collect()}


class ToxicityModel:
    """Features, trees and calibration; without trees, one score for every text."""

    def __init__(self, share: float, maker: FeatureMaker | None = None,
                 trees: GBTClassificationModel | None = None,
                 calibration: IsotonicRegressionModel | None = None):
        self.share, self.maker, self.trees, self.calibration = share, maker, trees, calibration

    @staticmethod
    def _margins(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
        made = trees.transform(rows.withColumn("features", array_to_vector("features")))
        return made.withColumn("margin", vector_to_array("rawPrediction")[1])

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, held_out, score and predicted of every row."""
        prepared(docs.sparkSession)
        rows = id_and_text(docs, id_col, text_col)
        if self.trees is None:
            scored = rows.select("doc_id", F.lit(self.share).alias("score"))
        else:
            margins = self._margins(with_features(rows, self.maker), self.trees).select("doc_id", "margin")
            scored = self.calibration.transform(margins)
        score = F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0))
        return scored.select("doc_id", held_out().alias("held_out"), score.alias("score"),
                             (score >= TOXIC_AT).cast("int").alias("predicted"))

    @classmethod
    def fit(cls, sample: DataFrame | None, share: float) -> "ToxicityModel":
        if sample is None:
            return cls(share)
        maker = FeatureMaker(learn_lexicon(sample.where("fold = 0")))
        rows = stage(with_features(sample.where("fold > 0"), maker).coalesce(8), "toxic-features")
        classes = {(r["fold"], r["toxic"]) for r in rows.select("fold", "toxic").distinct().collect()}
        if not {(1, 0), (1, 1)} <= classes or not classes & {(2, 0), (2, 1)}:
            return cls(share)
        trees = GBTClassifier(featuresCol="features", labelCol="toxic", weightCol="weight", maxIter=TREES,
                              maxDepth=DEPTH, stepSize=STEP, seed=SEED, checkpointInterval=-1).fit(
            rows.where("fold = 1").withColumn("features", array_to_vector("features")))
        margins = cls._margins(rows.where("fold = 2"), trees).select(
            "margin", F.col("toxic").cast("double").alias("toxic"), "weight")
        calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic", weightCol="weight",
                                         predictionCol="score").fit(margins)
        return cls(share, maker, trees, calibration)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_id_col: str = "doc_id", label_col: str = "toxic",
                   rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs``: doc_id, held_out, score, predicted."""
    prepared(docs.sparkSession)
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_id_col, label_col, rows)
    return ToxicityModel.fit(sample, share).score(docs, id_col, text_col)
