"""Allow or block URLs by rules, and by a logistic regression where no rule fits.

The regression sees hashed character n-grams of host and path and is fitted on the driver from
a small labelled table: a parameter, ``EXAMPLES`` by default, of ``MAX_EXAMPLES`` rows at most.
A null URL, or one without ``://``, has an empty host and path; the model judges these too.
"""

from __future__ import annotations

import json
import pkgutil
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import prepared

#: Host, path prefix, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
         ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
MAX_RULES = 500
MAX_EXAMPLES = 10_000
FEATURES = 1 << 12
GRAMS = (2, 3, 4)
CUT = 0.5

#: URLs of a small table, labelled by hand as a crawl would: block advertising, trackers, link spam,
#: pills, betting, adult pages, pirated files and fraud.
_TABLE = json.loads(pkgutil.get_data(__package__, "url_examples.json"))
EXAMPLES = [(url, int(verdict == "block")) for verdict in ("block", "allow") for url in _TABLE[verdict]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(host, upper, upper.lower()),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def split_url(url: str) -> tuple[str, str]:
    """``host_and_path`` for one Python string."""
    rest = url.partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, rest[cut:].partition("#")[0].partition("?")[0]


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (null without one); a rule fits its host
    and all subdomains where the path starts with the rule's."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = (((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}")))
                & F.startswith(path, F.lit(rule_path)))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _hashed(text: str, salt: int) -> list[np.ndarray]:
    codes = np.frombuffer(f"^{text}$".encode("utf-32-le"), np.uint32).astype(np.uint64)
    found = []
    for width in GRAMS:
        n = len(codes) - width + 1
        if n > 0:
            h = np.full(n, np.uint64(salt * 1000003 + width))
            for i in range(width):
                h = (h ^ codes[i:i + n]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
            found.append((h % np.uint64(FEATURES)).astype(np.int64))
    return found


def url_features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams; those of host and path differ."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *_hashed(host, 1), *_hashed(path, 2)]))


def fit(examples=EXAMPLES, penalty: float = 2e-4, steps: int = 400) -> np.ndarray:
    """Weights and bias, by accelerated gradient steps on the penalised mean log loss."""
    if len(examples) > MAX_EXAMPLES:
        raise ValueError(f"more than {MAX_EXAMPLES} examples")
    x = np.zeros((len(examples), FEATURES + 1))
    for row, (url, _) in zip(x, examples):
        at = url_features(*split_url(url))
        row[at] = 1 / np.sqrt(max(len(at), 1))
    x[:, FEATURES] = 1
    y = np.array([label for _, label in examples], float)
    w = ahead = np.zeros(FEATURES + 1)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ ahead)))
        grad = x.T @ (p - y) / max(len(y), 1) + penalty * ahead
        new, t_new = ahead - 1.9 * grad, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


def judge_urls(pages: DataFrame, rules=RULES, examples=EXAMPLES, cut: float = CUT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (the model's) of every row."""
    prepared(pages.sparkSession)
    weights = fit(examples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                at = url_features(host, path)
                margin = weights[at].sum() / np.sqrt(max(len(at), 1)) + weights[FEATURES]
                scores.append(float(1 / (1 + np.exp(-margin))))
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())],
                                  names=[*batch.schema.names, "block_score"])

    host, path = host_and_path(F.col(f"`{url_col}`"))
    parts = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                         host.alias("host"), path.alias("path"))
    scored = parts.mapInArrow(run, "page_id long, host string, path string, block_score double")
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    model = F.when(F.col("block_score") >= cut, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(says, model).alias("verdict"), "block_score")
