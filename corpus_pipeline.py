"""The corpus pipeline: from raw documents to encoded, mixed, de-duplicated ones.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all
but the last return the columns of ``docs``. ``run`` writes each stage's rows to the shared
folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, exact_dedup, language, mixing, near_dedup
from tidemark.llm.queries import WORD_BPE
from tidemark.llm.tables import ROW, identified, prepared, table, without
from tidemark.session import stage


#: Chunks of text that a worker of the last stage remembers: half of what op9_bpe_codec takes, as
#: workers go on to other stages with it.
REMEMBERED = 300_000
#: Languages whose documents stay, as predicted; None keeps every language.
LANGUAGES: frozenset[str] | None = None


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, one of ``LANGUAGES`` if set. Those without a letter go."""
    return language.accepted(docs, language.fit(docs), languages=LANGUAGES)


def all_but(rows: DataFrame, groups: DataFrame, best: Column) -> DataFrame:
    """Numbers (``gone``) of the members of ``groups`` (member, of) but the best of each, by the
    ``best`` struct of doc_id and number that is smallest."""
    members = rows.select(ROW, "doc_id").join(groups, F.col(ROW) == F.col("member")).select(
        "member", "of", best.alias("best"))
    firsts = members.groupBy(F.col("of").alias("group")).agg(F.min("best").alias("first"))
    return members.join(firsts, F.col("of") == F.col("group")).where(
        F.col("best") != F.col("first")).select(F.col("member").alias("gone"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id; of rows that share id and text too, or
    have no id, the first."""
    prepared(spark)
    rows, plain = identified(docs)
    found = exact_dedup.exact_duplicates(rows, id_col=ROW).where("group_size > 1")
    if plain:
        return without(rows, found.where("not kept").select(F.col("doc_id").alias("gone")))
    best = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("id"), ROW)
    groups = found.select(F.col("doc_id").alias("member"), F.col("keep_id").alias("of"))
    return without(rows, all_but(rows, groups, best))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies, the document with the smallest id; of rows that share it,
    the first. Rows without an id come last, and are compared like all others."""
    prepared(spark)
    rows, plain = identified(docs)
    found = near_dedup.near_duplicates(rows, id_col=ROW)
    if plain:
        return without(rows, found.where("not kept").select(F.col("doc_id").alias("gone")))
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    groups = found.select(F.col("doc_id").alias("member"), F.col("component_id").alias("of"))
    return without(rows, all_but(rows, groups, best))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to whole copies: a document of which less than
    half is taken goes, one of which two and a half are taken comes three times.

    The mix takes all documents of a source in whole repeats but the one at the trimmed end, so
    that a source's words miss its target by half of that document at most. A source with a
    target that would leave no document keeps the one of which most is taken.
    """
    prepared(spark)
    rows, _ = identified(docs)
    taken = stage(mixing.taken_rows(rows, row_col=ROW).where("taken > 0").select(
        "row_id", "source", "taken",
        F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("_copies")), "taken")
    most = F.max(F.struct("taken", (-F.col("row_id")).alias("first")))
    lone = (taken.groupBy("source").agg(most.alias("most"), F.sum("_copies").alias("n"))
            .where("n = 0").select((-F.col("most.first")).alias("row_id"),
                                   F.lit(1).alias("_copies")))
    words = taken.where("_copies > 0").select("row_id", "_copies").unionByName(lone)
    joined = rows.join(words, rows[ROW] == words["row_id"])
    copies = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return copies.select(*[rows[c] for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document of the mix."""
    return bpe_codec.encode_and_decode(docs, WORD_BPE, remembered=REMEMBERED)


STAGES = [
    ("language", with_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("encode", encoded),
]

#: Language models, the hashed order of the mix and byte-pair merges have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
