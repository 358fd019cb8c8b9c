"""Document quality rules, and verdicts on whole hosts from the failures of their documents.

The share of a host's documents that fail the base rule is shrunk towards all hosts' by a beta
prior, whose mean and strength come from the hosts themselves (moments of the beta-binomial).
A host whose shrunken rate is above ``max_rate`` loses all of its documents. Text measures are
taken in one pass and written to the shared folder, as hosts and documents both read them.

A null text has no words. Documents without a source are one host. Repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import prepared
from tidemark.llm.words import window_hashes, word_hashes
from tidemark.session import stage

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_RATE = 0.5
WINDOW = 5
#: Bounds of the prior's strength, in documents.
STRENGTH = (2.0, 1e6)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ROW = "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
#: First bytes of characters other than the white space between words.
_WORD_START = np.ones(256, np.int64)
_WORD_START[0x80:0xC0] = 0
_WORD_START[[0x20, *range(0x09, 0x0E)]] = 0


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words of repeated windows."""
    raw = np.frombuffer(text, np.uint8)
    seen = np.bincount(raw, minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip()]
    words = word_hashes(text)
    windows = window_hashes(words, WINDOW)
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    repeated = 0
    if len(times) < len(windows):
        edge = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(times[which] > 1)
        edge[at] += 1
        edge[at + WINDOW] -= 1
        repeated = int((np.cumsum(edge) > 0).sum())
    return (len(words), int(seen @ _WORD_START), int(seen @ _SYMBOL),
            len(lines) - len(set(lines)), repeated)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([measures(t.encode()) for t in texts], np.int64).reshape(-1, 5)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("host"),
                 *(pa.array(np.ascontiguousarray(c)) for c in found.T)],
                names=["doc_id", "host", *MEASURES])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{host_col}`").cast("string").alias("host"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, ROW)


def base_failed(min_words: int = MIN_WORDS, percent: int = MAX_REPEAT_PERCENT):
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > percent * F.col("n_words")))


def beta_prior(hosts: DataFrame, strength: tuple[float, float] = STRENGTH) -> tuple[float, float]:
    """The two beta parameters from ``hosts`` (n_docs, n_failed); four sums reach the driver."""
    first = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.count("*"),
                      F.sum(F.col("n_docs") * F.col("n_docs").cast("double"))).head()
    n, failed, k, squares = (float(v or 0) for v in first)
    if n == 0 or failed in (0.0, n):
        mean = failed / n if n else 0.5
        return mean * strength[1], (1 - mean) * strength[1]
    mean = failed / n
    spread = hosts.agg(F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - mean, 2))
                       ).head()[0]
    chance = mean * (1 - mean)
    base = n - squares / n  # equals 0 for a single host
    share = (spread / chance - (k - 1)) / (base - (k - 1)) if base > k - 1 else 0.0
    size = 1 / share - 1 if share > 0 else strength[1]
    size = min(max(size, strength[0]), strength[1])
    return mean * size, (1 - mean) * size


def host_verdicts(rows: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate (shrunken) and host_ok of every host."""
    hosts = rows.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    alpha, beta = beta_prior(hosts)
    rate = (F.col("n_failed") + alpha) / (F.col("n_docs") + (alpha + beta))
    return hosts.withColumn("rate", rate).withColumn("host_ok", F.col("rate") <= max_rate)


def judge(docs: DataFrame, max_rate: float = MAX_RATE, id_col: str = "doc_id",
          text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, the measures, base_failed, host_rate and kept of every row."""
    rows = stage(measured(docs, id_col, text_col, host_col)
                 .withColumn("base_failed", base_failed()), "host-quality")
    hosts = host_verdicts(rows, max_rate).select(
        F.col("host").alias("judged_host"), F.col("rate").alias("host_rate"), "host_ok")
    joined = rows.join(hosts, rows["host"].eqNullSafe(hosts["judged_host"]), "left")
    return joined.select("doc_id", *MEASURES, "base_failed", "host_rate",
                         (~F.col("base_failed") & F.col("host_ok")).alias("kept"))
