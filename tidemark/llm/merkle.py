"""Merkle manifest of a dataset: one tree per source, one tree over the sources.

A leaf is the SHA-256 of a row's fields. In every tree, runs of ``RUN`` consecutive nodes become
their parent until one node remains. A parent is built by one pass over its children, and keeps
a copy of the hash state before each child slot. Folding a changed child resumes the state of its
slot with the replacement and the siblings to its right; what lies to its left is never hashed
again.

Trees are cut into pieces of ``RUN ** LEVELS`` nodes, so that a source of any size is many small
groups. A way up gives each piece its top node, and the tops are the nodes of the next tier. A way
down hands each piece the runs that its top passes on the way to the root; the last step builds
the states of a piece of leaves once and folds every row through them.

Leaves of a source go by doc_id, null first, rows that share it by their leaf; equal rows are
leaves of their own. A null source is a source, the first. A null field counts as ``-``. A row
without doc_id is never tampered with. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidemark.llm.tables import prepared
from tidemark.session import stage

#: Children of a parent.
RUN = 16
#: Levels of a piece: a group holds RUN ** LEVELS rows at most.
LEVELS = 3
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ids whose CRC-32 this number divides are tampered with in the check.
TAMPERED = 5

_HEX = 64
TOP = "tree long, pos long, digest string, depth int"
PATH = "tree long, pos long, path binary"
CHECKED = "doc_id long, leaf string, tree long, proof_sha256 string, folded_root string"


class Parent:
    """A run of nodes under their parent, with the hash state before each child."""

    __slots__ = ("text", "states", "digest")

    def __init__(self, children: list[bytes]):
        state, self.states, self.text = hashlib.sha256(), [], b"".join(children)
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def others(self, slot: int) -> bytes:
        """The siblings of a slot, left to right."""
        return self.text[:slot * _HEX] + self.text[(slot + 1) * _HEX:]

    def fold(self, slot: int, child: bytes) -> bytes:
        """The parent's digest with another child in a slot."""
        state = self.states[slot].copy()
        state.update(child)
        state.update(self.text[(slot + 1) * _HEX:])
        return state.hexdigest().encode()


def build(nodes: list[bytes], levels: int) -> tuple[list[list[Parent]], bytes]:
    """Parents level by level over the nodes of a piece, and its top."""
    made = []
    for _ in range(levels):
        parents = [Parent(nodes[i:i + RUN]) for i in range(0, len(nodes), RUN)]
        nodes = [p.digest for p in parents]
        made.append(parents)
    return made, nodes[0]


def pack(steps: list[tuple[int, bytes]]) -> bytes:
    """Steps of a path: slot, number of nodes in the run, and the nodes."""
    return b"".join(bytes([slot, len(text) // _HEX]) + bytes.fromhex(text.decode())
                    for slot, text in steps)


def unpack(path: bytes) -> list[tuple[Parent, int]]:
    steps, at = [], 0
    while at < len(path):
        slot, n = path[at], path[at + 1]
        text = path[at + 2:at + 2 + n * _HEX // 2].hex().encode()
        steps.append((Parent([text[i:i + _HEX] for i in range(0, len(text), _HEX)]), slot))
        at += 2 + n * _HEX // 2
    return steps


def _rows(table: pa.Table, most: int) -> tuple[pa.Table, list[bytes], int]:
    table = table.sort_by("pos")
    nodes = [d.encode() for d in table.column("digest").to_pylist()]
    return table, nodes, min(most, table.column("depth")[0].as_py())


def _top(table: pa.Table, most: int) -> pa.Table:
    table, nodes, levels = _rows(table, most)
    first = table.slice(0, 1)
    return pa.table({
        "tree": first.column("tree"),
        "pos": pa.array([first.column("pos")[0].as_py() // RUN ** most], pa.int64()),
        "digest": pa.array([build(nodes, levels)[1].decode()]),
        "depth": pa.array([first.column("depth")[0].as_py() - levels], pa.int32())})


def _inner_steps(made: list[list[Parent]], at: int) -> list[tuple[int, bytes]]:
    steps = []
    for parents in made:
        steps.append((at % RUN, parents[at // RUN].text))
        at //= RUN
    return steps


def _paths(table: pa.Table, above: pa.Table, most: int) -> pa.Table:
    table, nodes, levels = _rows(table, most)
    made, _ = build(nodes, levels)
    rest = above.column("path")[0].as_py()
    paths = [pack(_inner_steps(made, i)) + rest for i in range(len(nodes))]
    return pa.table({"tree": table.column("tree"), "pos": table.column("pos"),
                     "path": pa.array(paths, pa.binary())})


def _fold(table: pa.Table, above: pa.Table, most: int) -> pa.Table:
    table, nodes, levels = _rows(table, most)
    made, _ = build(nodes, levels)
    upper = unpack(above.column("path")[0].as_py())
    proofs, folded = [], []
    for i, (leaf, other) in enumerate(zip(nodes, table.column("tampered").to_pylist())):
        proof, value, at = hashlib.sha256(), other.encode() if other is not None else leaf, i
        for parents in made:
            parent, slot = parents[at // RUN], at % RUN
            proof.update(parent.others(slot))
            value, at = parent.fold(slot, value), at // RUN
        for parent, slot in upper:
            proof.update(parent.others(slot))
            value = parent.fold(slot, value)
        proofs.append(proof.hexdigest())
        folded.append(value.decode())
    return pa.table({"doc_id": table.column("doc_id"), "leaf": table.column("digest"),
                     "tree": table.column("tree"), "proof_sha256": pa.array(proofs, pa.string()),
                     "folded_root": pa.array(folded, pa.string())})


def leaf_digest(*fields: Column) -> Column:
    """Lowercase hex SHA-256 of fields, each ``-`` if null, else byte count, colon and value."""
    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))
    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def leaf_rows(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
              source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, digest, tampered (null where the row is left alone) and row_id."""
    columns = [F.col(f"`{f}`") for f in fields]
    lowered = [F.translate(c, string.ascii_uppercase, string.ascii_lowercase) if f == text_col else c
               for f, c in zip(fields, columns)]
    crc = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        leaf_digest(*columns).alias("digest"),
        F.when(crc % TAMPERED == 0, leaf_digest(*lowered)).alias("tampered"),
        F.monotonically_increasing_id().alias("row_id"))


def positioned(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``: the place from 0 in the group (not null), by ``order``.

    Rows are dealt by ranges and sorted there; the places follow from one count per group and
    range, so a group of any size is spread over ranges.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "in-order")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = W.partitionBy("_group").orderBy("_of").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    joined = placed.join(starts, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of")))
    return joined.select(*rows.columns,
                         (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"))


def with_depth(nodes: DataFrame) -> tuple[DataFrame, int]:
    """``nodes`` (tree, ...) with the levels that their tree needs to come to one node, and the
    largest of these."""
    sizes = nodes.groupBy(F.col("tree").alias("_tree")).agg(F.count("*").alias("_n"))
    depth = sum((F.when(F.col("_n") > RUN ** k, 1).otherwise(0) for k in range(16)), F.lit(0))
    depths = stage(sizes.select("_tree", depth.cast("int").alias("depth")), "depths")
    deepest = depths.agg(F.max("depth")).head()[0] or 0
    return nodes.join(depths, nodes["tree"] == depths["_tree"]).drop("_tree"), deepest


def _piece(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("piece", F.expr(f"pos div {RUN ** levels}"))


def way_up(nodes: DataFrame, deepest: int, levels: int = LEVELS) -> list[DataFrame]:
    """Tiers of nodes (tree, pos, digest, depth): the given ones, then the tops of their pieces,
    down to one node per tree."""
    tiers = [nodes]
    while True:
        pieces = _piece(tiers[-1].select("tree", "pos", "digest", "depth"), levels)
        tiers.append(stage(pieces.groupBy("tree", "piece").applyInArrow(
            lambda key, table: _top(table, levels), TOP), "tops"))
        deepest -= levels
        if deepest <= 0:
            return tiers


def way_down(tiers: list[DataFrame], roots: DataFrame, last: int, levels: int = LEVELS) -> DataFrame:
    """Paths (tree, pos, path) from the nodes of tier ``last`` to the end of the paths of the
    ``roots``, which are those of the single nodes of the last tier."""
    paths = roots
    for nodes in reversed(tiers[last:-1]):
        pieces = _piece(nodes.select("tree", "pos", "digest", "depth"), levels)
        paths = stage(pieces.groupBy("tree", "piece").cogroup(paths.groupBy("tree", "pos"))
                      .applyInArrow(lambda table, above: _paths(table, above, levels), PATH), "paths")
    return paths


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
                    source_col: str = "source", text_col: str = "text", levels: int = LEVELS
                    ) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``proof_sha256`` is the digest of all siblings from the leaf to the root. ``folded_root`` is
    the root that follows from the row as it is found again: with its text in lower case (A-Z)
    where ``TAMPERED`` divides the CRC-32 of the id, else unchanged.
    """
    prepared(docs.sparkSession)
    leaves = stage(leaf_rows(docs, fields, id_col, source_col, text_col), "leaves")
    names = leaves.select("source").distinct().withColumn("all", F.lit(0).cast("long"))
    numbers = stage(positioned(names, "all", ["source"]).select(
        F.col("source").alias("of_source"), F.col("pos").alias("tree")), "source-numbers")
    rows = leaves.join(numbers, leaves["source"].eqNullSafe(numbers["of_source"])).select(
        "tree", "doc_id", "digest", "tampered", "row_id")
    rows = positioned(rows, "tree", ["doc_id", "digest", "row_id"]).drop("row_id")
    deep, deepest = with_depth(rows)
    rows = stage(deep, "leaf-nodes")
    tiers = way_up(rows, deepest, levels)

    subroots = tiers[-1].select(F.col("tree").alias("pos"), F.lit(0).cast("long").alias("tree"),
                                "digest")
    forest, height = with_depth(subroots)
    above = way_up(stage(forest, "subroots"), height, levels)
    root = (above[-1].select("digest").head() or [None])[0]
    start = above[-1].select("tree", "pos", F.lit(b"").alias("path"))
    tops = way_down(above, start, 0, levels).select(F.col("pos").alias("tree"),
                                            F.lit(0).cast("long").alias("pos"), "path")
    paths = way_down(tiers, tops, 1, levels)
    folded = (_piece(rows, levels).groupBy("tree", "piece").cogroup(paths.groupBy("tree", "pos"))
              .applyInArrow(lambda table, above: _fold(table, above, levels), CHECKED))
    ends = above[0].select(F.col("pos").alias("of_tree"), F.col("digest").alias("subroot"))
    return folded.join(ends, F.col("tree") == F.col("of_tree")).select(
        "doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == F.lit(root)).alias("verified"))


def manifest_sql(levels: int = 6, source_levels: int = 3) -> str:
    """The same over the table ``documents`` in SQL, for sources of up to ``RUN ** levels`` rows."""
    def field(name: str, value: str | None = None) -> str:
        value = value or name
        return (f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')")

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            [*[field(f) for f in FIELDS[:-1]], field("text", text)]) + ")"

    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    parts = [f"""
        crc AS (
          SELECT *, xor(list_reduce(
              list_prepend(4294967295::BIGINT, list_transform(
                string_split(doc_id::VARCHAR, ''), lambda c : ord(c)::BIGINT)),
              lambda a, b : list_reduce(
                list_prepend(xor(a, b), list_transform(range(8), lambda i : i::BIGINT)),
                lambda x, i : CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
            4294967295) AS code
          FROM documents),
        leaves AS (
          SELECT row_number() OVER () AS r, doc_id, source, {leaf('text')} AS leaf,
                 CASE WHEN code % {TAMPERED} = 0 THEN {leaf(lower)} END AS other
          FROM crc),
        numbers AS (
          SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
          FROM (SELECT DISTINCT source FROM leaves)),
        n0 AS (
          SELECT r, doc_id, tree, leaf AS digest, other,
                 row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos
          FROM leaves JOIN numbers ON leaves.source IS NOT DISTINCT FROM numbers.source)"""]
    last, nodes = "f0", "n0"
    parts.append("""
        f0 AS (SELECT r, doc_id, tree, pos, digest AS leaf, coalesce(other, digest) AS value,
                      '' AS proof FROM n0)""")

    def level(k: int) -> None:
        nonlocal last, nodes
        parts.append(f"""
        n{k} AS (
          SELECT tree, pos // {RUN} AS pos,
                 CASE WHEN any_value(size) = 1 THEN any_value(digest)
                 ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
          FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {nodes})
          GROUP BY tree, pos // {RUN})""")
        parts.append(f"""
        f{k} AS (
          SELECT f.r, any_value(f.doc_id) AS doc_id, f.tree, f.pos // {RUN} AS pos,
                 any_value(f.leaf) AS leaf, any_value(f.proof)
                   || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos <> f.pos), '')
                   AS proof,
                 CASE WHEN any_value(n.size) = 1 THEN any_value(f.value) ELSE
                   sha256(string_agg(CASE WHEN n.pos = f.pos THEN f.value ELSE n.digest END, ''
                                     ORDER BY n.pos)) END AS value
          FROM {last} f JOIN (SELECT *, count(*) OVER (PARTITION BY tree) AS size FROM {nodes}) n
            ON n.tree = f.tree AND n.pos // {RUN} = f.pos // {RUN}
          GROUP BY f.r, f.tree, f.pos)""")
        last, nodes = f"f{k}", f"n{k}"

    for k in range(1, levels + 1):
        level(k)
    parts.append(f"""
        subroots AS (SELECT 0 AS tree, tree AS pos, digest FROM {nodes})""")
    parts.append(f"""
        g0 AS (SELECT r, doc_id, tree AS own, 0 AS tree, tree AS pos, leaf, value, proof FROM {last})""")
    nodes, last = "subroots", "g0"
    for k in range(levels + 1, levels + source_levels + 1):
        level(k)
    return "WITH" + ",".join(parts) + f"""
        SELECT f.doc_id, f.leaf, s.digest AS subroot, t.digest AS root,
               sha256(f.proof) AS proof_sha256, f.value AS folded_root,
               f.value = t.digest AS verified
        FROM {last} f JOIN g0 ON g0.r = f.r JOIN subroots s ON s.pos = g0.own CROSS JOIN {nodes} t"""
