"""Merkle manifest of a data set: a digest per document, a tree of digests per source, and one over the sources.

The nodes of a tree stand in order, ``FAN`` consecutive ones are hashed into their parent, the last run may be shorter. One shuffle deals
the nodes into blocks of ``FAN ** LEVELS`` consecutive ones; a run never crosses a block's border, so ``LEVELS`` levels are built inside a block.
A node of level l stands on the row of its first leaf in the block, ``FAN ** l`` rows from its siblings: columns of ``lag`` and ``lead`` with that
offset, masked by the node's slot and the length of its run, hold the siblings, and the rows of first children hash the parents. The
last level's nodes are dealt into blocks in turn. So a source with a third of all documents spreads over its blocks, and each round leaves
1 / ``FAN ** LEVELS`` of the rows.

On the way down each block takes the path above it by one join on the same key, and a node's siblings reach all leaves below it as the last
values before them. Positions come from a range partitioning: a row's place in its sorted partition plus the rows of its tree in the partitions
before. Only ids and digests are shuffled, never texts.

Nulls in any column have a digest of their own; null ids come first, a null source is a tree of its own, before the others. Rows with one id
stand in order of their leaves, so that repeated rows are leaves of their own with equal digests. An empty table has an empty manifest. Other columns than
those hashed may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import staged

#: Children of a node.
FAN = 3
#: Levels that are built in one block.
LEVELS = 5
#: What a leaf hashes, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value that no other value or sequence of values is written like."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**instead: Column) -> Column:
    """The digest of a document; ``instead`` gives other values of its fields."""
    return digest(*[field(instead.get(c, F.col(f"`{c}`"))) for c in FIELDS])


def positions(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place in their tree (from 0), and ``n``, its size."""
    placed = (rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
              .withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)))
    placed = staged(rows.sparkSession, placed, "placed")
    parts = placed.groupBy(tree, "_part").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    of_tree = Window.partitionBy(tree)
    before = F.sum("_rows").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(tree, "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(of_tree).alias("n"))
    return placed.join(parts, [tree, "_part"]).withColumn("pos", F.col("_before") + F.col("_id") - F.col("_first")).drop(
        "_id", "_part", "_first", "_before")


def _block(fan: int, levels: int) -> Column:
    return F.floor(F.col("pos") / (fan ** levels)).cast("bigint")


def _climb(nodes: DataFrame, fan: int, levels: int, steps: bool) -> DataFrame:
    """``nodes`` (tree, block, pos, n, node) with ``node`` climbed by ``levels`` on the first rows of blocks; with ``steps``, column ``steps``
    holds the siblings (left, right) of each row's node of each level."""
    in_block = Window.partitionBy("tree", "block").orderBy("pos")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = []
    for level in range(levels):
        stride = fan ** level
        nodes_here = F.ceil(F.col("n") / stride)
        at = F.floor(F.col("pos") / stride)
        slot = at % fan
        run = F.least(F.lit(fan), nodes_here - (at - slot))
        stands = F.col("pos") % stride == 0
        near = {k: f"_near{'_' if k < 0 else ''}{abs(k)}" for k in range(1 - fan, fan) if k}
        # Masked: of what stands at that offset only the members of the node's own run.
        own = {k: F.when(stands & (slot + k >= 0) & (slot + k < run), (F.lag if k < 0 else F.lead)("node", abs(k) * stride).over(in_block))
               for k in near}
        nodes = nodes.withColumns({near[k]: F.coalesce(own[k], F.lit("")) for k in near})
        left, right = F.concat(*[F.col(near[k]) for k in near if k < 0]), F.concat(*[F.col(near[k]) for k in near if k > 0])
        more = nodes_here > 1
        if steps:
            names.append(f"_step{level}")
            here = F.when(stands & more, F.struct(left.alias("left"), right.alias("right")))
            nodes = nodes.withColumn(names[-1], F.last(here, ignorenulls=True).over(so_far))
        parent = F.when(stands & (slot == 0), F.when(more, digest(F.col("node"), right)).otherwise(F.col("node")))
        nodes = nodes.withColumn("node", parent).drop(*near.values())
    if steps:
        nodes = nodes.withColumn("steps", F.filter(F.array(*names), lambda s: s.isNotNull())).drop(*names)
    return nodes


def build(nodes: DataFrame, most: int, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """The levels kept, from ``nodes`` (tree, pos, n, node) up to one node per tree: every ``levels``-th. ``most`` is the largest ``n``."""
    kept = [nodes]
    while most > 1:
        dealt = kept[-1].select("tree", _block(fan, levels).alias("block"), "pos", "n", "node")
        first = _climb(dealt, fan, levels, steps=False).filter(F.col("pos") % (fan ** levels) == 0)
        up = first.select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / (fan ** levels)).alias("n"), "node")
        kept.append(staged(nodes.sparkSession, up, "nodes"))
        most = -(-most // fan ** levels)
    return kept


def descend(kept: Sequence[DataFrame], top: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The first of ``kept`` with what ``top`` (tree, path, ...) says of each tree, and ``path`` lengthened by the siblings down to each row."""
    said = [c for c in top.columns if c not in ("tree", "path")]
    above = top.withColumn("block", F.lit(0).cast("bigint"))
    for rows in reversed(kept[:-1]):
        dealt = rows.withColumn("block", _block(fan, levels)).withColumn("own", F.col("node")).join(above, ["tree", "block"])
        down = _climb(dealt, fan, levels, steps=True).withColumn("path", F.concat("steps", "path")).withColumn("node", F.col("own")).drop("steps", "own")
        above = down.select("tree", F.col("pos").alias("block"), "path", *said)
    if len(kept) > 1:
        return down.drop("block")
    return kept[0].join(above.drop("block"), "tree")


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` gives with the siblings of ``path``."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def proof(path: Column) -> Column:
    """The siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, found: Column | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, found (the leaf of the document as it is now; ``found`` is its expression, default: unchanged), path (array of left, right),
    subroot and root of every document."""
    spark = docs.sparkSession
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    own = leaf()
    leaves = staged(spark, docs.select("doc_id", tree.alias("tree"), own.alias("node"), (own if found is None else found).alias("found")), "leaves")
    ranked = staged(spark, positions(leaves, "tree", ["doc_id", "node"]), "ranked")
    most = ranked.agg(F.max("n")).first()[0] or 0
    kept = build(ranked.select("tree", "pos", "n", "node"), most, fan, levels)
    subroots = kept[-1].select(F.col("tree").alias("of"), F.col("node"), F.lit("").alias("tree"))
    subroots = staged(spark, positions(subroots, "tree", ["of"]), "subroots")
    n = subroots.agg(F.max("n")).first()[0] or 0
    over = build(subroots.select("tree", "pos", "n", "node"), n, fan, levels)
    root = F.lit(None).cast("string") if not n else F.lit(over[-1].first()["node"])
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = descend([subroots, *over[1:]], over[-1].select("tree").withColumn("path", no_path), fan, levels)
    top = top.select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "path")
    return descend([ranked, *kept[1:]], top, fan, levels).select("doc_id", F.col("node").alias("leaf"), "found", "path", "subroot", root.alias("root"))


def verified(entries: DataFrame) -> DataFrame:
    """``manifest`` with proof_sha256, folded_root (recomputed from the leaf found) and whether that is the root, instead of the path."""
    return entries.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.col("found"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
