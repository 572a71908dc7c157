"""A Merkle manifest of a dataset: one hash for all rows, and for each row the proof of its place.

Each row is a leaf, the leaves of a language are ordered by id and hashed in pairs, level by
level, to one subroot, and the subroots, ordered by language, are hashed likewise to the root.

The leaves of a language fall into superblocks of 2 ** `levels` neighbours, whose root is one node of
a smaller tree, which falls into superblocks again, until one is enough. Upwards each superblock
is reduced to its root. Downwards the nodes a superblock needs from outside, which are the
siblings on its way to the root, are cogrouped with its own nodes in one `applyInPandas`, which
finishes the local reduction, joins the proofs and folds the rows' claimed leaves to a root. So
a task holds one superblock and some ten outer nodes, only digests are shuffled, and the number
of rounds is the logarithm of the rows to the base of that number. Languages that are smaller than a
superblock share one, by hash.

Leaves are placed by a range sort over all rows, the sizes of the ranges being the only thing
that is counted in one place, so one language may hold all rows. Every round is written down.

Rows are ordered by id, null first, then by leaf; equal rows have equal leaves and may stand in
any order. Null values are `-`. A null language comes first. Columns other than the five do not
matter. An empty table gives an empty manifest. Texts are hashed whole, where they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import BROADCAST_ROWS
from tidemark.session import materialise

#: Levels of a superblock of 4,096 leaves, some 1 MB.
LEVELS = 12
#: The single tree over all subroots.
TOP = "top"


def _part(value: Column) -> Column:
    """A value as its length in bytes and itself, or `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """`doc_id`, `tree` (by language), `leaf`, and `claim`, the leaf of the row as it is claimed.

    Where `tampered`, the claimed row has one more in n_chars, unless that is null.
    """
    def leaf(n_chars: Column) -> Column:
        return F.sha2(F.concat(*(_part(v) for v in (
            F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")))), 256)

    # Decimals, since the largest number has one more too.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    original = leaf(F.col("n_chars"))
    return docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        # Null before the empty string, in the order of bytes.
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        original.alias("leaf"),
        F.when(tampered & more.isNotNull(), leaf(more)).otherwise(original).alias("claim"))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `at`, the place of each row within its tree in the given order, and the tree's `size`.

    `rows` must be written down and its `order` tell all rows apart but equal ones.
    """
    ordered = [F.col(c).asc_nulls_first() for c in ["tree", *order]]
    # The number of a row within its range, counted along the sorted partition.
    dealt = materialise(
        rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumns({
            "range": F.spark_partition_id(), "along": F.monotonically_increasing_id()}),
        "ranges")
    # A tree is in neighbouring ranges: rows here are at most the ranges and the trees.
    counted = materialise(
        dealt.groupBy("tree", "range").agg(F.min("along").alias("first"),
                                           F.count(F.lit(1)).alias("rows")), "range_sizes")
    of_tree = Window.partitionBy("tree")
    before = F.sum("rows").over(of_tree.orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1))
    starts = counted.select(
        "tree", "range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(of_tree).alias("size"))
    if counted.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    return dealt.join(starts, ["tree", "range"]).withColumn(
        "at", F.col("along") + F.col("shift")).drop("range", "along", "shift")


def _blocks(nodes: DataFrame, size: str, at: Column, packs: int, levels: int) -> DataFrame:
    """Adds `shelf` and `block`: the superblock, or for small trees the one they share."""
    large = F.col(size) > 1 << levels
    return nodes.withColumns({
        "shelf": F.when(large, F.concat(F.lit("t"), F.col("tree"))).otherwise(F.lit("s")),
        "block": F.when(large, at).otherwise(F.pmod(F.xxhash64("tree"), F.lit(packs)))})


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _reduced(digests: list[str], size: int, levels: int) -> Iterator[list[str]]:
    """The levels of a superblock from its nodes to its root, for a tree of `size` nodes."""
    yield digests
    for _ in range(min(levels, (size - 1).bit_length())):
        digests = [_digest("".join(digests[i:i + 2])) for i in range(0, len(digests), 2)]
        yield digests


def _trees(nodes: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The nodes of each tree in a superblock, in their order."""
    for _, one in nodes.groupby("tree", sort=False):
        yield one.sort_values("at", kind="stable")


@dataclass(frozen=True)
class Floor:
    """The nodes of all trees between two rounds, written down, with their superblocks.

    Columns: tree, at, size (of the tree), digest, below (size of the tree one floor lower), key
    (what the node stands for, if anything), shelf and block.
    """

    nodes: DataFrame
    packs: int
    largest: int
    levels: int

    @staticmethod
    def of(nodes: DataFrame, name: str, levels: int) -> Floor:
        for column, kind in (("key", "string"), ("below", "bigint")):
            if column not in nodes.columns:
                nodes = nodes.withColumn(column, F.lit(None).cast(kind))
        nodes = materialise(nodes, f"{name}_nodes")
        small, largest = nodes.agg(F.count_if(F.col("size") <= 1 << levels),
                                   F.coalesce(F.max("size"), F.lit(0))).first()
        packs = max(1, -(-small >> levels))
        block = F.shiftright("at", levels)
        return Floor(_blocks(nodes, "size", block, packs, levels), packs, largest, levels)

    def up(self) -> DataFrame:
        """The roots of the superblocks: the nodes of the next floor."""
        levels = self.levels

        def reduce(group: pd.DataFrame) -> pd.DataFrame:
            rows = []
            for one in _trees(group):
                first, size = one.iloc[0], int(one["size"].iloc[0])
                *_, (root,) = _reduced(one["digest"].tolist(), size, levels)
                rows.append((first["tree"], int(first["at"]) >> levels,
                             (size - 1 >> levels) + 1, size, root))
            return pd.DataFrame(rows, columns=["tree", "at", "size", "below", "digest"])

        nodes = self.nodes.select("shelf", "block", "tree", "at", "size", "digest")
        return nodes.groupBy("shelf", "block").applyInPandas(
            reduce, "tree string, at bigint, size bigint, below bigint, digest string")

    def joined(self, columns: list[str], outer: DataFrame, found: Callable,
               schema: str) -> DataFrame:
        """Cogroups every superblock with the outer nodes it needs.

        `outer` has a row per superblock's root: its tree and place on the floor above, its
        siblings from there on, the subroot and root, and the size of the floor `below` it, by
        which it finds its superblock. `found` makes rows of a node, its siblings from the
        superblock up to the root, with whether they are on the left, and the outer row.
        """
        levels, names = self.levels, [part.split()[0] for part in schema.split(", ")]

        def join(inner: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
            known = {(r.tree, r.at): r for r in outside.itertuples()}
            rows = []
            for one in _trees(inner):
                first, size = one.iloc[0], int(one["size"].iloc[0])
                way_out = known[first["tree"], int(first["at"]) >> levels]
                more, more_left = list(way_out.siblings), list(way_out.lefts)
                *reduced, _ = _reduced(one["digest"].tolist(), size, levels)
                for place, node in enumerate(one.itertuples()):
                    siblings, lefts = [], []
                    for level in reduced:
                        other = place ^ 1
                        siblings.append(level[other] if other < len(level) else None)
                        lefts.append(other < place)
                        place >>= 1
                    rows.append(found(node, siblings + more, lefts + more_left, way_out))
            return pd.DataFrame(rows, columns=names)

        nodes = self.nodes.select("shelf", "block", "tree", "at", "size", "digest", *columns)
        outside = _blocks(outer, "below", F.col("at"), self.packs, levels).select(
            "shelf", "block", "tree", "at", "siblings", "lefts", "subroot", "root")
        return nodes.groupBy("shelf", "block").cogroup(
            outside.groupBy("shelf", "block")).applyInPandas(join, schema)


def _up_to_roots(nodes: DataFrame, name: str, levels: int) -> list[Floor]:
    """All floors of the trees, from the given nodes to their roots."""
    floors = [Floor.of(nodes, name, levels)]
    while floors[-1].largest > 1:
        floors.append(Floor.of(floors[-1].up(), name, levels))
    return floors


def _down_from_roots(floors: list[Floor], outer: DataFrame) -> DataFrame:
    """The ways of all nodes of the lowest floor, from those of the topmost."""
    def way(node, siblings, lefts, out):
        return (node.tree, node.at, node.below, node.key, siblings, lefts, out.subroot, out.root)

    for floor in reversed(floors):
        outer = materialise(floor.joined(
            ["below", "key"], outer, way,
            "tree string, at bigint, below bigint, key string, siblings array<string>, "
            "lefts array<boolean>, subroot string, root string"), "ways")
    return outer


def _fold(claim: str, siblings: list, lefts: list) -> str:
    """The root that a leaf and its siblings give."""
    for sibling, left in zip(siblings, lefts):
        claim = _digest(claim if sibling is None else sibling + claim if left else claim + sibling)
    return claim


def manifest(docs: DataFrame, tampered: Column, levels: int = LEVELS) -> DataFrame:
    """Per row: `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified`.

    The proof is that of the rows as they are; `folded_root` is recomputed from the claimed leaf
    and the original siblings, and `verified` tells whether it is the root.
    """
    one, nothing = F.lit(1).cast("bigint"), F.lit(None).cast("string")
    written = materialise(
        leaves(docs, tampered).withColumn("row", F.monotonically_increasing_id()), "leaves")
    lowest = Floor.of(_placed(written, ["doc_id", "leaf", "row"]).withColumnRenamed(
        "leaf", "digest"), "leaf", levels)

    # Upwards: each language to its subroot, the subroots to the root.
    languages = _up_to_roots(lowest.up(), "language", levels)
    subroots = materialise(languages[-1].nodes.select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("key"), "digest"), "subroots")
    top = _up_to_roots(_placed(subroots, ["key"]), "top", levels)

    # Downwards: the ways of the subroots, then of the nodes of every floor.
    outer = _down_from_roots(top, top[-1].nodes.select(
        "tree", "at", F.col("size").alias("below"),
        F.array().cast("array<string>").alias("siblings"),
        F.array().cast("array<boolean>").alias("lefts"), nothing.alias("subroot"),
        F.col("digest").alias("root")))
    outer = outer.drop("tree", "at", "below", "subroot").join(subroots, "key").select(
        F.col("key").alias("tree"), F.lit(0).cast("bigint").alias("at"), one.alias("below"),
        "siblings", "lefts", F.col("digest").alias("subroot"), "root")
    outer = _down_from_roots(languages, outer)

    def finished(node, siblings, lefts, out):
        folded = _fold(node.claim, siblings, lefts)
        return (node.doc_id, node.digest, out.subroot, out.root,
                _digest("".join(s for s in siblings if s is not None)), folded,
                folded == out.root)

    # Ids as text, since pandas would make numbers with nulls inexact.
    lowest = replace(lowest, nodes=lowest.nodes.withColumn(
        "doc_id", F.col("doc_id").cast("string")))
    return lowest.joined(
        ["doc_id", "claim"], outer, finished,
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean").withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))


def tampered_by_crc(divisor: int = 7) -> Column:
    """Rows whose id, written in decimal, has a CRC-32 that `divisor` divides."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == 0, F.lit(False))
