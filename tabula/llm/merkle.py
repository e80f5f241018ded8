"""Merkle manifest of a dataset: one tree per group of rows, one tree over the groups, a proof for every row.

Every row is a leaf, the hash of its fields. Per group, leaves are numbered in order and every ``FANOUT`` consecutive
nodes (a run; the last one may be shorter, even a single node) become one node, the hash of their digests, until one
node, the subroot, remains; subroots in group order make the root in the same way.

A level is one window per ``BLOCK`` consecutive nodes of a group: lag and lead columns at the fixed offsets 1 to
FANOUT - 1, masked by the node's slot in its run and by the run's length, are its siblings to the left and right, and
the rows of a run's first child hash the parents. Blocks bound what a task sorts at a time, so a group holding a third
of all rows is spread over as many tasks as it has blocks. Levels are built upwards from written tables, each 1/16 of
the one below; ancestors' siblings then come down level by level by a join on (tree, block, run), for which both
sides lie in the same place already. The driver sees the number of levels only.

The siblings from leaf to root are a row's proof: folding a leaf with them gives the root again if and only if the row
is unchanged.

Cases: null fields count as ``-``; the null group comes first; null order keys come first; rows that repeat an order
key are ordered by leaf, and rows that repeat all fields are interchangeable; a single leaf is its own subroot and a
single subroot the root (a proof without siblings is the hash of nothing); an empty table gives no rows; names of
further columns don't matter, as only the named ones are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, keep

FANOUT = 16
BLOCK = FANOUT * FANOUT


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(c: Column) -> Column:
    """One field as hashed: ``-`` for null, else its number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(*columns: Column) -> Column:
    return digest(F.concat(*[field(c) for c in columns]))


_ORDER = "OVER (PARTITION BY tree, block ORDER BY num NULLS LAST)"
_RUN = "OVER (PARTITION BY tree, block, run)"
_OFFSETS = range(1, FANOUT)
_PLACE = [f"num div {BLOCK} AS block", f"num div {FANOUT} AS run", f"CAST(num % {FANOUT} AS INT) AS slot"]
_NEIGHBOURS = [f"lag(hash, {k}) {_ORDER} AS before{k}" for k in _OFFSETS]
_NEIGHBOURS += [f"lead(hash, {k}) {_ORDER} AS after{k}" for k in _OFFSETS]
_NEIGHBOURS += [f"count(hash) {_RUN} AS length"]
_LEFT = ", ".join(f"CASE WHEN slot >= {k} THEN before{k} END" for k in reversed(_OFFSETS))
_RIGHT = ", ".join(f"CASE WHEN slot + {k} < length THEN after{k} END" for k in _OFFSETS)
_SIBLINGS = ["block", "run", "slot", f"concat_ws('', {_LEFT}) AS left", f"concat_ws('', {_RIGHT}) AS right"]


def with_siblings(nodes: DataFrame, told: DataFrame | None = None) -> DataFrame:
    """Nodes (tree, num, hash, ...) with ``left`` and ``right``, the joined digests of the siblings on each side, and
    ``alone``: whether the node is the last one of its tree, that is its subroot.

    ``told`` (tree, block, run, up) tells every node of a run its ``up``; its rows, which have no number and so come
    after the block's nodes, go through the same windows, so that no join moves siblings about.
    """
    rows = nodes.selectExpr("*", *_PLACE)
    if told is None:
        rows = rows.withColumn("up", F.lit(None))
    else:
        rows = rows.unionByName(told, allowMissingColumns=True)
    rows = rows.selectExpr("*", *_NEIGHBOURS, f"any_value(up, true) {_RUN} AS above").where("hash IS NOT NULL")
    return rows.selectExpr(*nodes.columns, *_SIBLINGS, "above", "num = 0 AND after1 IS NULL AS alone")


def _numbered(rows: DataFrame, tag: str) -> DataFrame:
    """Rows (tree, place, hash, ...) with ``num`` from 0 per tree in the order of place and hash.

    Rows are dealt by ranges of that order, so a large tree lies in many partitions; a row's number is its position in
    the partition plus the tree's rows in earlier ones. Rows alike in tree, place and hash are dealt by where they
    were read, so that repeats of one row spread as well.
    """
    order = ["tree", "place", "hash", "tie"]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).drop("tie")
    dealt = keep(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), f"{tag}-dealt")
    held = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    num = (F.col("at") - F.col("first") + F.col("before")).alias("num")
    own = [c for c in rows.columns if c not in ("tree", "place", "hash")]
    return keep(dealt.join(held, ["tree", "part"]).select("tree", num, "hash", *own), f"{tag}-0")


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level: hashed at the rows of first children, of groups that have more than one node."""
    first = with_siblings(nodes.select("tree", "num", "hash")).where((F.col("slot") == 0) & ~F.col("alone"))
    return first.select("tree", F.col("run").alias("num"), digest(F.concat("hash", "right")).alias("hash"))


def _levels(leaves: DataFrame, tag: str) -> list[DataFrame]:
    """The tables of nodes (tree, num, hash) from the leaves up to the level where every group has one node."""
    levels = [leaves]
    while not (above := keep(_parents(levels[-1]), f"{tag}-{len(levels)}")).isEmpty():
        levels.append(above)
    return levels


def _subroots(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, level, hash): of each group its last node. Levels above a group's subroot have no node of it."""
    out = None
    for at, nodes in enumerate(levels):
        first = nodes.where("num = 0").select("tree", F.lit(at).alias("level"), "hash")
        out = first if out is None else out.unionByName(first)
    top = out.groupBy("tree").agg(F.max(F.struct("level", "hash")).alias("top"))
    return top.select("tree", "top.level", "top.hash")


def _paths(levels: Sequence[DataFrame], above: DataFrame, tag: str) -> DataFrame:
    """The leaves with ``up``: a struct of ``path`` (siblings from the own run up) and what else ``above``, (tree,
    level, up) of the trees' subroots with the path that goes on from there, says of the tree."""
    more = [c for c in above.schema["up"].dataType.names if c != "path"]
    told = None
    for at in range(len(levels) - 1, -1, -1):
        runs = above.where(F.col("level") == at).select("tree", F.lit(0).cast("long").alias("run"), "up")
        runs = runs if told is None else runs.unionByName(told)
        rows = with_siblings(levels[at], runs.selectExpr("*", f"run div {FANOUT} AS block"))
        path = F.concat(F.array(F.struct("left", "right")), F.col("above.path"))
        path = F.when(F.col("alone"), F.col("above.path")).otherwise(path).alias("path")
        here = rows.select(*levels[at].columns, F.struct(path, *[f"above.{c}" for c in more]).alias("up"))
        if at:
            told = keep(here.select("tree", F.col("num").alias("run"), "up"), f"{tag}-paths-{at}")
    return here


def manifest(
    rows: DataFrame, group: str, order: str, leaf: str, carry: Sequence[str] = ()
) -> DataFrame:
    """(carry..., leaf, subroot, root, path) for each row: ``path`` lists (left, right), the joined digests of the
    siblings on each side, from the row's own run up to the root's children."""
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(order).alias("place"), F.col(leaf).alias("hash"), F.struct(*carry).alias("row"),
    )
    leaves = _numbered(keep(named, "merkle-rows"), "merkle")
    levels = _levels(leaves, "merkle")
    subs = keep(_subroots(levels), "merkle-subroots")
    sub = F.struct("tree", "level").alias("sub")
    tops = _numbered(subs.select(F.lit("").alias("tree"), F.col("tree").alias("place"), "hash", sub), "merkle-top")
    top_levels = _levels(tops, "merkle-top")
    ends = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    root = _subroots(top_levels).select("tree", "level", F.struct(ends, F.col("hash").alias("root")).alias("up"))
    above = _paths(top_levels, root, "merkle-top")
    up = F.struct("up.path", F.col("hash").alias("subroot"), "up.root").alias("up")
    above = keep(above.select("sub.tree", "sub.level", up), "merkle-above")
    out = _paths(levels, above, "merkle")
    return out.select("row.*", F.col("hash").alias("leaf"), "up.subroot", "up.root", "up.path")


def proof_hash(path: Column) -> Column:
    """The hash of all siblings of a path, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, a tree per source; verifies every row against it after tampering with some:
    where 5 divides crc32(doc_id as decimal text), the text is lower-cased before the row is hashed again."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    leaf = leaf_hash(*fields, F.col("text"))
    changed = F.when(tampered, leaf_hash(*fields, ascii_lower(F.col("text")))).otherwise(F.col("leaf"))
    rows = docs.withColumn("leaf", leaf).select("doc_id", "source", "leaf", changed.alias("found"))
    out = manifest(rows, "source", "doc_id", "leaf", carry=["doc_id", "found"])
    out = out.withColumn("folded_root", fold(F.col("found"), F.col("path")))
    return out.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
