"""A Merkle manifest with persistent, path-copying versions (operator 12).

Every document is a leaf; the leaves of a language, in ascending ``doc_id``, form a binary tree,
and the roots of the languages, in order of the language, form the tree above.  A tree is a set of
*aligned blocks*: ``2 ** BLOCK_BITS`` neighbours of one level and all nodes above them up to their
common ancestor.  Blocks of leaves lead to a level of block roots, those to blocks again, until one
node is left; so every task holds one block, whatever the number of leaves.

A tampered leaf makes a *version*: a tree that shares every node the leaf does not reach.  Only the
ancestors are copied, first those inside the leaf's block, then, from the version's own block root
on, those in the blocks above.  What a version needs from there is the siblings along its block's
way up; they are found once per block, by joins of block tables tier by tier, not once per leaf.

Steps:

1. Leaves are hashed by Spark's ``sha2`` and stored (no texts from here on).
2. They are range-partitioned and sorted; a running sum of the partitions' counts gives every leaf
   its place.  The row's number enters the sort key, so that equal rows are spread as well.
3. Leaves are packed into blocks, one stored row each, with the block's root.
4. The block roots are packed and reduced tier by tier; every tier stores each node's way up.
5. Each block gets the way above it and yields its leaves' proofs and versions.

Scale: the leaves are shuffled twice, as digests and ids of about 100 bytes.  A block's row holds at
most ``2 ** BLOCK_BITS`` leaves.  The tables of counts and of ways have a row per partition and per
block; they are broadcast only where a measured size allows it.

Defined cases: a NULL in a leaf's field is ``-``; an empty or very long text is hashed as it is;
a NULL ``doc_id`` comes first in its language and is never tampered with; ties of ``doc_id`` are
ordered by digest; repeated rows are leaves of their own; a NULL ``n_chars`` stays NULL when tampered
with, so that leaf verifies; one leaf is its own root; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..session import materialize

BLOCK_BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
#: One step of a way up: 0 no sibling, 1 sibling on the left, 2 on the right; then its digest.
STEP = 33


def digest(data: bytes) -> bytes:
    """H of digests and texts: the lowercase hex sha256, as ASCII bytes."""
    return hashlib.sha256(data).hexdigest().encode()


# ---------------------------------------------------------------- leaves


def field_text(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` for NULL, else its bytes' number, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """The leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(fields[f]) for f in FIELDS]), 256))


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % TAMPER_EVERY == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, node, changed): a language, its leaves and, where tampered with, the other leaf."""
    own = {f: F.col(f) for f in FIELDS}
    more = own | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"),  # NULL sorts first
        "doc_id", leaf_digest(own).alias("node"), F.when(tampered(F.col("doc_id")), leaf_digest(more)).alias("changed"))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0 in the tree) and ``n`` (of the tree), without a single-task window."""
    keys = ["tree", *order]
    nodes = nodes.withColumn("_row", F.monotonically_increasing_id())  # read from a stored table
    ranked = materialize(
        nodes.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row").drop("_row")
        .withColumn("_at", F.monotonically_increasing_id()), "merkle-ranked")
    part = F.shiftright("_at", 33)
    counts = ranked.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = materialize(counts.withColumns({"_before": F.coalesce(before, F.lit(0)), "n": F.sum("_n").over(tree)}),
                         "merkle-counts").drop("_n")
    return (ranked.withColumn("_part", part).join(checked_broadcast(counts), ["tree", "_part"])
            .withColumn("place", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_before", "_first"))


# ---------------------------------------------------------------- one block


def levels_left(n: int, tier: int, bits: int) -> int:
    """How many levels a tree of ``n`` leaves has inside the blocks of a tier."""
    return max(0, min(bits, (n - 1).bit_length() - bits * tier))


def block_levels(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of a block, level by level, as hex; the last level has one."""
    out = [nodes]
    for _ in range(levels):
        low = out[-1]
        out.append([digest(b"".join(low[i:i + 2])) for i in range(0, len(low), 2)])
    return out


def way_up(levels: list[list[bytes]], i: int) -> list[tuple[int, bytes]]:
    """(side, sibling) of node ``i`` and its ancestors below the block's root."""
    out = []
    for low in levels[:-1]:
        j = i ^ 1
        out.append((0, b"") if j >= len(low) else (1 if j < i else 2, low[j]))
        i >>= 1
    return out


def copied(node: bytes, way: list[tuple[int, bytes]]) -> list[bytes]:
    """The ancestors of a version of a node: the only nodes that the version does not share."""
    out = []
    for side, other in way:
        node = digest(node if not side else other + node if side == 1 else node + other)
        out.append(node)
    return out


def packed_way(way: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + (bytes.fromhex(other.decode()) if side else bytes(32)) for side, other in way)


def unpacked_way(data: bytes) -> list[tuple[int, bytes]]:
    return [(data[k], data[k + 1:k + STEP].hex().encode() if data[k] else b"") for k in range(0, len(data), STEP)]


# ---------------------------------------------------------------- blocks and tiers


def packed(nodes: DataFrame, extra: list[str], bits: int) -> DataFrame:
    """One row per block: its nodes in order, its tree's ``n`` and the columns ``extra`` as lists."""
    held = F.struct("place", "node", *extra)
    rows = (nodes.groupBy("tree", F.shiftright("place", bits).alias("block"))
            .agg(F.array_sort(F.collect_list(held)).alias("_held"), F.first("n").alias("n")))
    return rows.select("tree", "block", "n", *[F.col(f"_held.{c}").alias(c) for c in ("node", *extra)])


def with_roots(blocks: DataFrame, tier: int, bits: int) -> DataFrame:
    """``blocks`` with ``root``, the node their nodes lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [bytes.fromhex(block_levels([x.hex().encode() for x in nodes], levels_left(n, tier, bits))[-1][0].decode())
                     for n, nodes in zip(batch["n"].to_pylist(), batch["node"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())],
                                             names=[*batch.schema.names, "root"])

    return blocks.mapInArrow(run, blocks.withColumn("root", F.lit(b"")).schema)


def ways(blocks: DataFrame, tier: int, bits: int) -> DataFrame:
    """(tree, place, way) of every node of a tier: its siblings up to its block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = block_levels([x.hex().encode() for x in row["node"]], levels_left(row["n"], tier, bits))
                k = len(row["node"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * k, pa.string()),
                     pa.array(range(row["block"] << bits, (row["block"] << bits) + k), pa.int64()),
                     pa.array([packed_way(way_up(levels, i)) for i in range(k)], pa.binary())],
                    names=["tree", "place", "way"])

    return blocks.select("tree", "block", "n", "node").mapInArrow(run, "tree string, place long, way binary")


def upper_ways(blocks: DataFrame, most: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """((tree, block, way) from each leaf block's root to its tree's root, (tree, root)).

    ``most`` is the number of leaves of the largest tree; it fixes the number of tiers.
    """
    tiers: list[DataFrame] = []
    tier, low = 0, blocks
    while levels_left(most, tier + 1, bits):
        tier += 1
        low = packed(low.select("tree", F.col("block").alias("place"), F.col("root").alias("node"), "n"), [], bits)
        low = materialize(with_roots(low, tier, bits), "merkle-tier")
        tiers.append(materialize(ways(low, tier, bits), "merkle-ways"))
    out = blocks.select("tree", "block", F.lit(b"").alias("way"))
    for k, up in enumerate(tiers):
        up = up.select("tree", F.col("place").alias("_place"), F.col("way").alias("_way"))
        out = (out.withColumn("_place", F.shiftright("block", k * bits)).join(checked_broadcast(up), ["tree", "_place"])
               .select("tree", "block", F.concat("way", "_way").alias("way")))
    return out, low.select("tree", "root")


def most_leaves(blocks: DataFrame) -> int:
    return blocks.agg(F.max("n").alias("n")).first()["n"] or 0


class Manifest:
    """The stored blocks of all trees, each with its way to the root of all."""

    def __init__(self, docs: DataFrame, bits: int = BLOCK_BITS):
        self.bits = bits
        nodes = placed(materialize(leaves(docs), "merkle-leaves"), ["doc_id", "node"])
        blocks = materialize(with_roots(packed(nodes, ["doc_id", "changed"], bits), 0, bits), "merkle-blocks")
        way, subroots = upper_ways(blocks, most_leaves(blocks), bits)
        # the tree above the languages, by the same steps
        tops = placed(materialize(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("node")),
                                  "merkle-subroots"), ["of"])
        top = materialize(with_roots(packed(tops, ["of"], bits), 0, bits), "merkle-top")
        above, root = upper_ways(top, most_leaves(top), bits)
        names = materialize(ways(top, 0, bits), "merkle-ways").withColumnRenamed("way", "_own")
        above = above.select(F.col("block").alias("_block"), F.col("way").alias("_above"))
        place = tops.select(F.col("of").alias("tree"), F.col("node").alias("subroot"), "place",
                            F.shiftright("place", bits).alias("_block"))
        langs = (place.join(names.drop("tree"), "place").join(checked_broadcast(above), "_block")
                 .select("tree", "subroot", F.concat("_own", "_above").alias("_top")))
        root = root.select(F.col("root").alias("root_of_all"))  # one row, or none
        self.ways = materialize(way.join(checked_broadcast(materialize(langs, "merkle-langs")), "tree")
                                .select("tree", "block", F.concat("way", "_top").alias("way"), "subroot"), "merkle-ways")
        self.blocks, self.root = blocks, root.first()

    def leaves(self) -> DataFrame:
        """(tree, doc_id, leaf, subroot, siblings, changed, copied) of every leaf.

        ``siblings`` are all from the leaf to the root of all, ``copied`` the nodes of the leaf's
        version: the ancestors of the tampered leaf, or of the leaf itself.
        """
        bits = self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    nodes = [x.hex().encode() for x in row["node"]]
                    levels = block_levels(nodes, levels_left(row["n"], 0, bits))
                    above = unpacked_way(row["way"])
                    siblings, versions = [], []
                    for i, (node, other) in enumerate(zip(nodes, row["changed"], strict=True)):
                        way = way_up(levels, i) + above
                        siblings.append([s.decode() for _, s in way if s])
                        versions.append([v.decode() for v in copied(node if other is None else other.hex().encode(), way)])
                    k = len(nodes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]] * k, pa.string()), pa.array(row["doc_id"], pa.int64()),
                         pa.array([x.decode() for x in nodes], pa.string()),
                         pa.array([row["subroot"].hex()] * k, pa.string()),
                         pa.array(siblings, pa.list_(pa.string())),
                         pa.array([x and x.hex() for x in row["changed"]], pa.string()),
                         pa.array(versions, pa.list_(pa.string()))],
                        names=["tree", "doc_id", "leaf", "subroot", "siblings", "changed", "copied"])

        rows = (self.blocks.drop("root").join(checked_broadcast(self.ways), ["tree", "block"]))
        return rows.mapInArrow(run, "tree string, doc_id long, leaf string, subroot string, siblings array<string>, "
                                    "changed string, copied array<string>")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    m = Manifest(docs)
    root = F.lit(m.root["root_of_all"].hex() if m.root else None).cast("string")
    # a tree of one leaf has no ancestors to copy
    own = F.coalesce(F.col("changed"), F.col("leaf"))
    folded = F.coalesce(F.try_element_at("copied", F.lit(-1)), own)
    return m.leaves().select(
        "doc_id", "leaf", "subroot", root.alias("root"),
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == root).alias("verified"))


def versions(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, height, digest): the nodes that each tampered leaf's version does not share, leaf first."""
    m = Manifest(docs)
    rows = m.leaves().where(F.col("changed").isNotNull() & (F.col("changed") != F.col("leaf")))
    nodes = F.concat(F.array("changed"), F.col("copied"))
    return rows.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("lang"), "doc_id",
                       F.posexplode(nodes).alias("height", "digest"))
