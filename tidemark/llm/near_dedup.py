"""Near duplicates by min-max hashing of word shingles, with exact confirmation.

Each permutation of a text's shingle hashes gives two signature values, its minimum and its
maximum, so a signature of 2 * PERMUTATIONS values costs PERMUTATIONS evaluations. A band joins
minima of some permutations with maxima of others, whose matches are independent. At the
threshold of 0.85 two texts share none of the 44 bands with a probability below 1e-6.

Texts of equal shingle sets are one class, found by a digest of the set, and only its smallest
doc_id goes on. Links between classes are found in three rounds. First every bucket's members are
compared with its smallest member alone, which costs one pair per member and joins groups of
copies of any size. Then the same is done with each bucket's most central member, the one with
the least share of shingles that no other component has. What still lies in different
components, though in a common bucket, is compared pair by pair unless it cannot be linked: two
linked sets share one of their rarest shingles (a prefix in the order of rarity), and neither can
have more shingles of its own than the threshold allows. So no link is lost among bucket mates,
and groups of copies are not expanded into pairs. A comparison is an exact intersection of both
whole sets, each set recomputed only for texts that meet another in some bucket.

A text without words (or a null one) has an empty set and links with nothing. Rows without
doc_id link with nothing either and are components of their own. Rows that share a doc_id are
one document, linked with whatever one of them is linked with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.tables import id_and_text, prepared
from tidemark.llm.words import mix, shingle_set
from tidemark.session import mark, stage, stage_last

WIDTH = 5
#: Least similarity of linked texts, in percent.
PERCENT = 85
BANDS, ROWS = 44, 8
PERMUTATIONS = BANDS * ROWS // 2
#: Shingles per step of the signature, which bounds its memory.
STEP = 1024

_random = np.random.default_rng(85)
_FACTOR = _random.integers(1, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_ROW = _random.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_HALF = ROWS // 2
_MIN_AT = np.arange(PERMUTATIONS).reshape(BANDS, _HALF)
_MAX_AT = np.roll(_MIN_AT, BANDS // 2, axis=0)

SIGNATURE_ROW = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the shingles under every permutation."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(short), STEP):
        values = short[at:at + STEP, None] * _FACTOR + _SHIFT
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return low, high


def band_keys(shingles: np.ndarray) -> np.ndarray:
    low, high = signature(shingles)
    rows = np.concatenate([low[_MIN_AT], high[_MAX_AT]], axis=1).astype(np.uint64)
    return mix((rows * _ROW).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for text in batch.column("text").to_pylist():
            shingles = shingle_set(text.encode(), WIDTH)
            sizes.append(len(shingles))
            keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            bands.append(band_keys(shingles).view(np.int64) if len(shingles)
                         else np.zeros(0, np.int64))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t.encode(), WIDTH).view(np.int64)
                for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("rep"), pa.array(sets, pa.list_(pa.int64()))],
                              names=["rep", "shingles"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sorted sets reach the threshold."""
    for batch in batches:
        left, right = batch.column("left_set"), batch.column("right_set")
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a = left[i].values.to_numpy()
            b = right[i].values.to_numpy()
            at = np.searchsorted(a.view(np.uint64), b.view(np.uint64))
            at[at == len(a)] = 0
            both = int((a[at] == b).sum())
            keep[i] = 100 * both >= PERCENT * (len(a) + len(b) - both)
        yield pa.record_batch([batch.column("u"), batch.column("v")],
                              names=["u", "v"]).filter(pa.array(keep))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) of ``pairs`` (u, v and the set sizes u_size, v_size) that are linked.

    Sizes rule out most pairs; the sets of the rest meet by two joins on their ids, the hot id
    of a large group coming last so that nothing is shuffled by it with both sets attached.
    """
    possible = pairs.where((100 * F.least("u_size", "v_size")
                            >= PERCENT * F.greatest("u_size", "v_size")))
    left = sets.select(F.col("rep").alias("u"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("rep").alias("v"), F.col("shingles").alias("right_set"))
    both = (possible.select("u", "v").join(right, "v").join(left, "u")
            .select("u", "v", "left_set", "right_set"))
    return both.mapInArrow(_common, "u long, v long")


def open_members(labelled: DataFrame) -> DataFrame:
    """rep, size and label of all members of buckets that hold more than one label."""
    groups = labelled.select("bucket", "label").distinct()
    mixed = groups.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("bucket").alias("mixed_bucket"))
    return (labelled.join(mixed, labelled["bucket"] == mixed["mixed_bucket"], "left_semi")
            .select("rep", "size", "label").distinct())


def rarest(members: DataFrame, sets: DataFrame) -> DataFrame:
    """rep, size, common, keys: of each member, how many shingles members of other labels have
    too, and the rarest of these, enough that two linked members of different labels share one.

    Of n shingles in a common order, a partner at the threshold shares one of the first
    n - ceil(0.85 n) + 1. Shingles of a single label lead the order and meet nobody, so they are
    counted and left out; the others follow by rarity.
    """
    tokens = (members.join(sets.select(F.col("rep").alias("of"), "shingles"),
                           F.col("rep") == F.col("of"))
              .select("rep", "size", "label", F.explode("shingles").alias("key")))
    shared = tokens.groupBy("key").agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where(
        "lo < hi").select(F.col("key").alias("shared_key"), "n")
    ranked = (tokens.join(shared, F.col("key") == F.col("shared_key"))
              .groupBy("rep", "size")
              .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("found")))
    common = F.size("found")
    length = F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1
    wanted = F.greatest(length - (F.col("size") - common), F.lit(0)).cast("int")
    return ranked.select("rep", "size", common.alias("common"),
                         F.slice("found", F.lit(1), wanted)["key"].alias("keys"))


def may_link(a: str, b: str) -> Column:
    """Whether the sizes and common shingles of two members allow a link.

    A side may also be a whole label, with the range of its sizes and its largest common count:
    columns ``_size`` (least), ``_most`` (largest size) and ``_common``.
    """
    least = F.col(f"{a}_size") + F.col(f"{b}_size")
    return ((100 * F.col(f"{a}_most") >= PERCENT * F.col(f"{b}_size"))
            & (100 * F.col(f"{b}_most") >= PERCENT * F.col(f"{a}_size"))
            & ((100 + PERCENT) * F.least(f"{a}_common", f"{b}_common") >= PERCENT * least))


def central_pairs(rows: DataFrame) -> DataFrame:
    """Of each bucket, the member with the least share of shingles of its own, paired with the
    members of other labels. ``rows``: bucket, rep, size, common, label."""
    share = (F.col("common") / F.col("size")).alias("share")
    centre = (rows.groupBy("bucket").agg(F.max(F.struct(
        share, (-F.col("rep")).alias("first"), "size", "common", "label")).alias("c"))
        .select(F.col("bucket").alias("of"), (-F.col("c.first")).alias("u"),
                F.col("c.size").alias("u_size"), F.col("c.size").alias("u_most"),
                F.col("c.common").alias("u_common"), F.col("c.label").alias("u_label")))
    others = rows.select("bucket", F.col("rep").alias("v"), F.col("size").alias("v_size"),
                         F.col("size").alias("v_most"), F.col("common").alias("v_common"),
                         F.col("label").alias("v_label"))
    return (others.join(centre, F.col("bucket") == F.col("of"))
            .where((F.col("u_label") != F.col("v_label")) & may_link("u", "v"))
            .select("u", "v", "u_size", "v_size").distinct())


def across(known: DataFrame) -> DataFrame:
    """Pairs of members that differ in label, share one of their ``keys`` and may be linked.
    ``known``: rep, size, common, keys, label.

    Labels of a key are paired first, where their ranges of sizes allow a link, and then filled
    with their members, the fewer first, so that members of one label never meet each other. A
    pair comes from the first key that it shares.
    """
    keyed = known.withColumn("key", F.explode("keys"))
    groups = keyed.groupBy("key", "label").agg(
        F.min("size").alias("size"), F.max("size").alias("most"), F.max("common").alias("common"),
        F.count("*").alias("n"))

    def side(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        return rows.select(F.col("key").alias(f"{name}_key"),
                           *[F.col(c).alias(f"{name}_{c}") for c in columns])

    whole = ("label", "size", "most", "common")
    left, right = side(groups, "p", "n", *whole), side(groups, "q", "n", *whole)
    smaller = (F.col("p_n") < F.col("q_n")) | ((F.col("p_n") == F.col("q_n"))
                                               & (F.col("p_label") < F.col("q_label")))
    labels = left.join(right, (F.col("p_key") == F.col("q_key"))
                       & (F.col("p_label") != F.col("q_label")) & smaller & may_link("p", "q"))
    one = keyed.withColumn("most", F.col("size"))
    u, v = (side(one, name, "rep", *whole, "keys") for name in "uv")
    half = labels.join(u, (F.col("p_key") == F.col("u_key"))
                       & (F.col("p_label") == F.col("u_label")) & may_link("u", "q"))
    first = F.element_at(F.array_intersect("u_keys", "v_keys"), 1)
    return half.join(v, (F.col("q_key") == F.col("v_key")) & (F.col("q_label") == F.col("v_label"))
                     & may_link("u", "v") & (first == F.col("v_key"))).select(
        F.col("u_rep").alias("u"), F.col("v_rep").alias("v"), "u_size", "v_size")


def merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links (a written table) between their members."""
    if links.isEmpty():
        return components
    stars = components.select(F.col("vertex").alias("u"), F.col("component").alias("v"))
    return connected_components(stars.unionByName(links))


def ids_of_several_sets(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between a doc_id whose rows have different sets and the classes of these."""
    lo, hi = (f(F.xxhash64("set_key")) for f in (F.min, F.max))
    several = signed.groupBy(F.col("doc_id").alias("of")).agg(lo.alias("lo"), hi.alias("hi")).where("lo <> hi")
    rows = signed.select("doc_id", "set_key").join(several, F.col("doc_id") == F.col("of"), "left_semi")
    keys = classes.withColumnRenamed("set_key", "class_key")
    return rows.join(keys, F.col("set_key") == F.col("class_key")).select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v")).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    spark = prepared(docs.sparkSession)
    since = mark(spark)
    texts = id_and_text(docs, id_col, text_col)
    signed = stage(texts.mapInArrow(_signatures, SIGNATURE_ROW), "signatures")
    usable = F.col("n_shingles").between(1, (1 << 62)) & F.col("doc_id").isNotNull()
    classes = stage(signed.where(usable).groupBy("set_key").agg(F.min("doc_id").alias("rep")),
                    "set-classes")

    first = classes.withColumnRenamed("set_key", "class_key")
    firsts = (signed.where(usable).join(first, (signed["set_key"] == first["class_key"])
                                         & (signed["doc_id"] == first["rep"]), "left_semi"))
    banded = firsts.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"),
                            F.explode("bands").alias("band"))
    centres = (banded.groupBy("band")
               .agg(F.min(F.struct("rep", "size")).alias("c"), F.count("*").alias("n"))
               .where("n > 1").select(F.col("band").alias("bucket"), F.col("c.rep").alias("centre"),
                                      F.col("c.size").alias("centre_size")))
    buckets = stage(banded.join(centres, banded["band"] == centres["bucket"])
                    .select("bucket", "centre", "centre_size", "rep", "size"), "buckets")
    met = buckets.select(F.col("rep").alias("met")).distinct()
    wanted = texts.select(F.col("doc_id").alias("rep"), "text")
    sets = stage(wanted.join(met, wanted["rep"] == met["met"], "left_semi")
                 .mapInArrow(_sets, "rep long, shingles array<long>").where("size(shingles) > 0"),
                 "shingle-sets")

    star = (buckets.where("rep <> centre")
            .select(F.col("centre").alias("u"), F.col("rep").alias("v"),
                    F.col("centre_size").alias("u_size"), F.col("size").alias("v_size")).distinct())
    links = confirmed(star, sets).unionByName(ids_of_several_sets(signed.where(usable), classes))
    joined = connected_components(links)

    labelled = buckets.join(joined, buckets["rep"] == joined["vertex"], "left").select(
        "bucket", "rep", "size", F.coalesce("component", "rep").alias("label"))
    members = stage(open_members(labelled), "open-members")
    if not members.isEmpty():
        joined = across_components(labelled, members, sets, joined)

    components = joined.select(F.col("vertex").alias("member"), "component")
    keys = classes.join(components, classes["rep"] == components["member"], "left").select(
        F.col("set_key").alias("class_key"), F.coalesce("component", "rep").alias("class_component"))
    rows = signed.select("doc_id", "n_shingles", "set_key")
    found = rows.join(keys, (rows["set_key"] == keys["class_key"]) & usable, "left")
    component = F.coalesce("class_component", "doc_id")
    return stage_last(found.select("doc_id", "n_shingles", component.alias("component_id"),
                                   F.col("doc_id").eqNullSafe(component).alias("kept")), "near-classes", since)


def across_components(labelled: DataFrame, members: DataFrame, sets: DataFrame,
                      joined: DataFrame) -> DataFrame:
    """``joined`` with the links between members of one bucket that it leaves apart: first those
    of each bucket's central member, then those of all pairs that may still be linked."""
    known = stage(rarest(members, sets), "rarest-shingles")
    counted = known.select(F.col("rep").alias("known_rep"), "common")
    central = central_pairs(labelled.join(counted, labelled["rep"] == counted["known_rep"]))
    joined = merged(joined, stage(confirmed(central, sets), "central-links"))

    known = known.join(joined, known["rep"] == joined["vertex"], "left").select(
        "rep", "size", "common", "keys", F.coalesce("component", "rep").alias("label"))
    late = stage(confirmed(across(stage(known, "labelled-members")), sets), "late-links")
    return merged(joined, late)
