"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe_codec, exact_dedup, host_quality, language, lexical_search, licenses, merkle, mixing,
    near_dedup, token_count, token_files, toxicity, url_filter)
from tidemark.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op3_token_counts(spark, sf_dir):
    return token_count.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op4_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op5_host_quality(spark, sf_dir):
    found = host_quality.judge(table(spark, sf_dir, "documents"))
    return found.drop("host_rate")


@query
def op6_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("block_score")


@query
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_license_scan(spark, sf_dir):
    return licenses.license_coverage(table(spark, sf_dir, "documents"))


@query
def op9_bpe_codec(spark, sf_dir):
    return bpe_codec.encode_and_decode(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op10_source_mix(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark, sf_dir):
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"))


@query
def op13_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL: dict[str, str] = {
    "op11_lexical_search": lexical_search.SQL,
    "op12_merkle_manifest": merkle.manifest_sql(),
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op5_host_quality": r"""
        WITH texts AS (
          SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t
          FROM documents),
        split AS (
          SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)),
                             lambda l : regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
          FROM texts),
        places AS (
          SELECT r, i, w[i:i+4] AS win
          FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
        twice AS (
          SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM places)
          WHERE n > 1),
        repeats AS (
          SELECT r, count(DISTINCT i + o) AS n
          FROM twice, (SELECT unnest(range(5)) AS o) GROUP BY r),
        measured AS (
          SELECT doc_id, host, len(w) AS n_words,
                 coalesce(list_sum(list_transform(w, lambda x : length(x))), 0)::BIGINT AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
                 len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                 coalesce(n, 0) AS n_repeat_words
          FROM split LEFT JOIN repeats USING (r)),
        based AS (
          SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
          FROM measured),
        hosts AS (
          SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS f
          FROM based GROUP BY host),
        sums AS (
          SELECT sum(n) AS n, sum(f) AS f, count(*)::DOUBLE AS k, sum(n * n) AS q,
                 sum(f) / sum(n) AS m FROM hosts),
        spread AS (
          SELECT sums.*, (SELECT sum(h.n * pow(h.f / h.n - m, 2)) FROM hosts h) / (m * (1 - m)) AS s,
                 sums.n - q / sums.n AS b FROM sums),
        sized AS (
          SELECT *, CASE WHEN f = 0 OR f = n THEN 1e6
                    WHEN b > k - 1 AND s > k - 1
                    THEN least(greatest((b - (k - 1)) / (s - (k - 1)) - 1, 2.0), 1e6)
                    ELSE 1e6 END AS size FROM spread),
        verdicts AS (
          SELECT h.host, (h.f + m * size) / (h.n + size) <= 0.5 AS ok FROM hosts h, sized)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND ok AS kept
        FROM based JOIN verdicts ON based.host IS NOT DISTINCT FROM verdicts.host""",
    "op7_near_dedup": r"""
        WITH RECURSIVE split AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, array_to_string(w[i:i+4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
                  FROM split WHERE len(w) > 0))),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
          SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
          WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
        both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
        reach AS (
          SELECT doc_id, doc_id AS seen FROM documents
          UNION SELECT reach.doc_id, both_ways.v FROM reach JOIN both_ways ON reach.seen = both_ways.u),
        components AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
        SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id,
               documents.doc_id = component_id AS kept
        FROM documents JOIN components ON components.doc_id = documents.doc_id
        LEFT JOIN sizes ON sizes.doc_id = documents.doc_id""",
}
