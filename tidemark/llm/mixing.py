"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a row of 2**m slots of ``block`` words each. Slot j draws the van der Corput point of
j, which is a permutation of the 2**m grid points. The sources lie on the grid one after the
other, each with as many points as its target has blocks, the trimmed last one included, so every
block has one slot and any stretch of the schedule is close to the targets. Points behind the last
source stay empty. The slots of a source are ranked; slot rank r takes block r of the source's
word stream. The stream is its documents in an order shuffled by hash, repeated as
often as the target asks, cut into equal blocks and trimmed at the target.

Running sums and ranks go by chunks (hash ranges of documents, ranges of slots): sums per chunk
first, then inside each chunk, so that a source with a third of all rows is not one task.

A null text has no words and a null source is a source of its own, the last. Rows that repeat a
doc_id count each. Only rows of documents that have words are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidemark.llm.tables import prepared
from tidemark.session import stage

#: Weights by position of a source, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives its words this often, at most.
MAX_REPEATS = 3
#: Slots are at least so many per source, and hold this many words at most.
SLOTS_PER_SOURCE = 1024
BLOCK_WORDS = 1024
#: Documents, or slots, per chunk of a running sum.
CHUNK_ROWS = 4096
#: Grid points per cell of the join that finds a point's source.
CELL_POINTS = 1024

SIZE_ROW = "doc_id long, source string, size long, row_id long, draw long"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """doc_id, source, the number of words, a row number (``row_col``, if given) and a draw of
    every row, the hash that places it in its source: of id and text, without an id of the row
    number too."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(t.encode().split()) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64()),
                 batch.column("row_id"), batch.column("draw")],
                names=["doc_id", "source", "size", "row_id", "draw"])

    row = F.col(f"`{row_col}`").cast("long") if row_col else F.monotonically_increasing_id()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                       row.alias("row_id"))
    alone = F.when(F.col("doc_id").isNull(), F.col("row_id"))
    draw = F.xxhash64("doc_id", F.xxhash64("text"), alone, F.lit("mix"))
    return rows.withColumn("draw", draw).mapInArrow(run, SIZE_ROW)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, weight, target: one row per source.

    Raising the target per unit of weight until the total is reached, sources stop in order of
    repeats * size / weight: those below the final level keep their limit, the others share what
    is left by weight. One row per source goes through one sort.
    """
    by_source = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                 .withColumn("limit_words", F.lit(repeats) * F.col("source_size")))
    position = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (position % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn(
        "stop", F.col("limit_words") / F.col("weight"))
    order = W.orderBy("stop", F.col("source").asc_nulls_last())
    up_to = order.rowsBetween(W.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    level = ((total - F.coalesce(F.sum("limit_words").over(up_to), F.lit(0)))
             / F.sum("weight").over(from_here))
    # The level at the first source that does not stop before it; larger for none that follow.
    filled = ranked.withColumn("level", F.when(level <= F.col("stop"), level))
    final = F.first("level", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    target = F.coalesce(F.col("weight") * final, F.col("limit_words").cast("double"))
    return filled.select("source", "source_size", "weight",
                         F.least(target, F.col("limit_words").cast("double")).alias("target"))


def _starts(rows: DataFrame, group: Column, chunk: Column, order: list, value: str,
            name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over earlier rows of the group, by chunks."""
    rows = rows.withColumns({"_group": group, "_chunk": chunk})
    before = W.partitionBy("_g").orderBy("_c").rowsBetween(W.unboundedPreceding, -1)
    chunks = (rows.groupBy(F.col("_group").alias("_g"), F.col("_chunk").alias("_c"))
              .agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum"))
    inside = (W.partitionBy("_group", "_chunk").orderBy(*order)
              .rowsBetween(W.unboundedPreceding, -1))
    local = rows.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(chunks, F.col("_group").eqNullSafe(F.col("_g"))
                        & (F.col("_chunk") == F.col("_c")))
    return joined.withColumn(name, F.col("_before") + F.col("_local")).drop(
        "_group", "_chunk", "_g", "_c", "_before", "_local")


def schedule(shares: DataFrame, slots: int, block: int) -> DataFrame:
    """slot, source_no and rank of every slot that a source owns, one per block of its quota.

    ``shares``: source_no and quota (words).
    """
    spark = shares.sparkSession
    bits = slots.bit_length() - 1
    blocks = F.ceil(F.col("quota") / F.lit(block)).cast("long")
    end = F.sum("blocks").over(W.orderBy("source_no").rowsBetween(W.unboundedPreceding, 0))
    owners = (shares.select("source_no", blocks.alias("blocks"))
              .withColumn("end_point", end)
              .withColumn("first_point", F.col("end_point") - F.col("blocks"))
              .where("first_point < end_point")
              .withColumn("cell", F.explode(F.sequence(
                  F.floor(F.col("first_point") / CELL_POINTS).cast("long"),
                  F.floor((F.col("end_point") - 1) / CELL_POINTS).cast("long")))))
    digits = F.lpad(F.bin("point"), bits, "0") if bits else F.lit("0")
    points = spark.range(slots).select(
        F.col("id").alias("point"), F.floor(F.col("id") / CELL_POINTS).cast("long").alias("point_cell"))
    points = points.withColumn("slot", F.conv(F.reverse(digits), 2, 10).cast("long"))
    owned = points.join(owners, (F.col("point_cell") == F.col("cell"))
                        & (F.col("point") >= F.col("first_point"))
                        & (F.col("point") < F.col("end_point"))).select(
        "slot", "source_no", F.lit(1).cast("long").alias("one"))
    return _starts(owned, F.col("source_no"), F.floor(F.col("slot") / CHUNK_ROWS), ["slot"],
                   "one", "rank").drop("one")


def shares_of(sources: DataFrame) -> DataFrame:
    """``sources`` (see ``targets``) with a number, and the whole words that the source may give
    (``quota``)."""
    quota = F.least(F.round("target").cast("long"), MAX_REPEATS * F.col("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("quota", quota).withColumn(
        "source_no", F.row_number().over(order).cast("long"))


def schedule_size(total: int, sources: int) -> tuple[int, int]:
    """Number of slots (a power of two) and words per block, so that the blocks of all sources,
    each with a last one that may be trimmed, have a slot."""
    wanted = max(SLOTS_PER_SOURCE * sources, -(-total // BLOCK_WORDS) + sources, 1)
    slots = 1 << (wanted - 1).bit_length()
    return slots, max(1, -(-total // max(1, slots - sources)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source",
        row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with their sizes and targets, and the mix.

    Rows: row_id (``row_col``, if given), doc_id, source, size, source_size, target. Mix: slot, rank, row_id, epoch,
    from_word and n_words: the words of that row that the slot holds. Slots in ascending order
    are the mix; a slot holds pieces of one source.
    """
    sizes = stage(sized(docs, id_col, text_col, source_col, row_col), "sizes")
    sources = stage(shares_of(targets(sizes, weights)), "sources")
    total, n_sources, n_rows = (
        int(v or 0) for v in (*sources.agg(F.sum("quota"), F.count("*")).head(), sizes.count()))
    slots, block = schedule_size(total, n_sources)
    bits = min(32, max(1, (n_rows // CHUNK_ROWS).bit_length()))

    names = sources.select(F.col("source").alias("of_source"), "source_no", "source_size",
                           "target", "quota")
    rows = sizes.join(names, sizes["source"].eqNullSafe(names["of_source"])).drop("of_source")
    shuffled = rows.where("size > 0")
    placed = _starts(shuffled, F.col("source_no"), F.shiftrightunsigned("draw", 64 - bits),
                     ["draw", "doc_id", "size", "row_id"], "size", "start")
    epochs = F.ceil(F.col("quota") / F.col("source_size")).cast("int")
    copies = (placed.where("quota > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
              .withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("start"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota")))
              .where("lo < hi"))
    first, last = (F.floor(c / F.lit(block)).cast("long")
                   for c in (F.col("lo"), F.col("hi") - 1))
    begin = F.greatest("lo", F.col("block") * block)
    pieces = (copies.withColumn("block", F.explode(F.sequence(first, last)))
              .select("row_id", "epoch", F.col("source_no").alias("piece_source"), "block",
                      (begin - F.col("lo")).alias("from_word"),
                      (F.least("hi", (F.col("block") + 1) * block) - begin).alias("n_words")))
    plan = schedule(sources, slots, block)
    mixed = plan.join(pieces, (F.col("source_no") == F.col("piece_source"))
                      & (F.col("rank") == F.col("block")))
    return rows, mixed.select("slot", "rank", "row_id", "epoch", "from_word", "n_words")


def taken_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source",
               row_col: str | None = None) -> DataFrame:
    """row_id, doc_id, source, size, source_size, target and taken of every row."""
    rows, mixed = mix(docs, weights, id_col, text_col, source_col, row_col)
    sums = mixed.groupBy(F.col("row_id").alias("mixed_row")).agg(F.sum("n_words").alias("words"))
    return rows.join(sums, rows["row_id"] == sums["mixed_row"], "left").select(
        "row_id", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken and source of every row."""
    return taken_rows(docs, weights, id_col, text_col, source_col).select(
        "doc_id", "size", "source_size", "target", "taken", "source")
