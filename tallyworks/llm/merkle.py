"""A Merkle manifest of a dataset, in Van Emde Boas layout.

A leaf is the digest of a row. The leaves of a tree (the rows of one value of a column) stand in
ascending order of an id; every two neighbours give the digest above them, a last one alone gives
one by itself, until one is left. The roots of the trees, by the trees' names, are the leaves of
one more tree, whose root stands for the dataset.

A tree is kept as aligned subtrees of ``BLOCK_HEIGHT`` levels, one row each. The nodes of a block
lie in Van Emde Boas order: the block is split at half its height, the upper part comes first and
then the lower ones, each laid out the same way, so a walk from a leaf to the root stays within
few neighbouring stretches whatever the size of a cache line. ``addresses`` works out where a
node lies; it serves the construction and the retrieval of siblings. The roots of the blocks are
the leaves of the next tier of blocks, and so on. No task ever holds more than one block of a
tree at a time, and the driver gets the number of leaves of the largest tree and one digest.

Defined cases: a NULL value counts as ``-``. NULL ids come first, rows with equal ids stand in the
order of their digests; rows that are equal throughout are interchangeable, and each has a
position of its own. A NULL tree name comes before all others, "" included. Empty tables have no
rows in any result, and no root.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.llm import common  # noqa: F401 - functions of this package travel with tasks
from tallyworks.session import keep_table

BLOCK_HEIGHT = 10
_DIGEST = 32
# One step of a path: a sibling to the left, to the right, or none.
_STEP = re.compile(rb"([<>])([0-9a-f]{64})|=")


def addresses(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where nodes lie in a complete tree of ``levels`` levels: the ``index``-th ones of a depth."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    lower = levels - upper
    if depth < upper:
        return addresses(depth, index, upper)
    below = depth - upper
    subtree, inside = index >> below, index & ((1 << below) - 1)
    first = (1 << upper) - 1 + subtree * ((1 << lower) - 1)
    return first + addresses(below, inside, lower)


_places: dict[tuple[int, int], np.ndarray] = {}


def _row_addresses(depth: int, levels: int) -> np.ndarray:
    if (depth, levels) not in _places:
        _places[depth, levels] = addresses(depth, np.arange(1 << depth), levels)
    return _places[depth, levels]


def joined(nodes: Sequence[bytes]) -> bytes:
    """The node above a run of nodes; digests are hashed as hexadecimal text."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def grow(leaves: Sequence[bytes], height: int) -> bytes:
    """A block of ``height`` levels above its leaves; places without a node are zero."""
    levels = height + 1
    store = np.zeros(((1 << levels) - 1, _DIGEST), np.uint8)
    row = list(leaves)
    for depth in range(height, -1, -1):
        place = _row_addresses(depth, levels)[: len(row)]
        store[place] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, _DIGEST)
        row = [joined(row[at : at + 2]) for at in range(0, len(row), 2)]
    return store.tobytes()


def paths(block: bytes, height: int, size: int, above: bytes) -> list[bytes]:
    """For each of the ``size`` leaves the siblings on its way up, then those of ``above``.

    A step is ``<`` or ``>`` (the side where the sibling stands) with its digest, or ``=``.
    """
    levels = height + 1
    found = [above]
    for depth in range(1, levels):
        count = math.ceil(size / (1 << (height - depth)))
        place = _row_addresses(depth, levels)
        row = []
        for index in range(count):
            other = index ^ 1
            step = b"="
            if other < count:
                at = int(place[other]) * _DIGEST
                sibling = block[at : at + _DIGEST].hex().encode()
                step = (b">" if other > index else b"<") + sibling
            row.append(step + found[index >> 1])
        found = row
    return found


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings on its path lead to."""
    node = leaf
    for step in _STEP.finditer(path):
        side, sibling = step.groups()
        other = [bytes.fromhex(sibling.decode())] if sibling else []
        node = joined([*other, node] if side == b"<" else [node, *other])
    return node


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 (hexadecimal) of the values: each ``-`` if NULL, else its UTF-8 length, ``:``, itself."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def _positions(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``position`` in their ``tree`` and ``n``, the leaves of that tree.

    Rows are sorted over all tasks and kept with their place. What counts the rows before
    them is one row for each tree in each task.
    """
    ranged = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    kept = keep_table(ranged.withColumn("place", F.monotonically_increasing_id()))
    # The number of the task stands in the upper bits of the place.
    kept = kept.withColumn("part", F.shiftright("place", 33))
    runs = kept.groupBy("tree", "part").agg(
        F.min("place").alias("first"), F.count("*").alias("size")
    )
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("size").over(tree).alias("n"),
    )
    placed = kept.join(runs, ["tree", "part"])
    return placed.withColumn("position", F.col("place") + F.col("base")).drop(
        "place", "part", "base"
    )


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """One row for each block: its nodes, and the root of each."""
    leaf = F.struct("position", "digest")
    runs = nodes.groupBy("tree", F.shiftright("position", height).alias("block"), "n").agg(
        F.sort_array(F.collect_list(leaf))["digest"].alias("leaves")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heights, stores = [], []
            for n, leaves in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                heights.append(min(height, (n - 1).bit_length()))
                stores.append(grow(leaves, heights[-1]))
            sizes = pa.array(batch.column(3).value_lengths(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    sizes,
                    pa.array(heights, pa.int32()),
                    pa.array(stores, pa.binary()),
                    # The root is first in this order, at every level of the recursion.
                    pa.array([store[:_DIGEST] for store in stores], pa.binary()),
                ],
                ["tree", "block", "n", "size", "height", "nodes", "root"],
            )

    schema = "tree string, block long, n long, size int, height int, nodes binary, root binary"
    return runs.mapInArrow(work, schema)


def _tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Blocks over the nodes, then over the blocks' roots, until every tree has one block."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    tiers = []
    while True:
        tiers.append(keep_table(_blocks(nodes, height)))
        if largest <= 1 << height:
            return tiers
        nodes = tiers[-1].where(F.col("n") > 1 << height).select(
            "tree",
            F.col("block").alias("position"),
            F.col("root").alias("digest"),
            F.ceil(F.col("n") / (1 << height)).alias("n"),
        )
        largest = math.ceil(largest / (1 << height))


def _roots(tiers: list[DataFrame], height: int) -> DataFrame:
    """``tree``, ``root``."""
    tops = [tier.where(F.col("n") <= 1 << height).select("tree", "root") for tier in tiers]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


def _with_paths(tiers: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The lowest tier's blocks with ``above``, the path from a block's root.

    ``above`` gives the path from each tree's root.
    """
    found = None
    for tier in reversed(tiers):
        tops = tier.where(F.col("n") <= 1 << height).join(above, "tree")
        if found is None:
            found = tops
            continue
        inner = _leaf_paths(found).withColumnsRenamed({"position": "block", "path": "above"})
        rest = tier.where(F.col("n") > 1 << height).join(inner, ["tree", "block"])
        found = tops.unionByName(rest)
    return found


def _leaf_paths(blocks: DataFrame) -> DataFrame:
    """``tree``, ``position``, ``path`` of each leaf of some blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = paths(row["nodes"], row["height"], row["size"], row["above"])
                # Blocks of one tier, and of one tree, are all of one height but for single ones.
                first = row["block"] << row["height"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(found), pa.string()),
                        pa.array(range(first, first + len(found)), pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    ["tree", "position", "path"],
                )

    wanted = blocks.select("tree", "block", "size", "height", "nodes", "above")
    return wanted.mapInArrow(work, "tree string, position long, path binary")


@dataclass
class Manifest:
    """A dataset's leaves and blocks, as tables in the shared folder.

    ``leaves``: ``tree``, ``id``, ``digest`` and ``presented`` (the digest of the changed row,
    NULL where it is not changed), ``position``, ``n``. ``tiers`` and ``top`` are the blocks of the
    trees and of the tree over their roots, lowest first; ``root`` is the dataset's, or None.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    top_leaves: DataFrame
    top: list[DataFrame]
    root: bytes | None
    block_height: int

    def proofs(self) -> DataFrame:
        """Per row: ``id``, ``leaf``, ``subroot``, ``root``, ``proof`` (siblings from the leaf to
        the root, as one text), ``folded_root`` of the row as presented, and ``verified``.

        Each block meets its own rows only, once, with the path above it.
        """
        root, height = self.root or b"", self.block_height
        start = self.top[-1].select("tree", F.lit(b"").alias("above")).distinct()
        lifted = _leaf_paths(_with_paths(self.top, start, height)).select("position", "path")
        named = self.top_leaves.select(
            "position", F.col("name").alias("tree"), F.col("digest").alias("subroot")
        )
        above = named.join(lifted, "position").select("tree", F.col("path").alias("above"))
        blocks = _with_paths(self.tiers, above, height).join(named.drop("position"), "tree")
        row = F.struct("position", "id", "digest", "presented")
        rows = self.leaves.groupBy("tree", F.shiftright("position", height).alias("block")).agg(
            F.sort_array(F.collect_list(row)).alias("rows")
        )
        wanted = blocks.join(rows, ["tree", "block"]).select(
            "size", "height", "nodes", "above", "subroot", "rows"
        )

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    size, tall, nodes, over, subroot = (
                        batch.column(column)[at].as_py() for column in range(5)
                    )
                    members = batch.column(5)[at].values
                    leaves = members.field("digest").to_pylist()
                    shown = members.field("presented").to_pylist()
                    found = paths(nodes, tall, size, over)
                    folded = [
                        fold(leaf if other is None else other, path)
                        for leaf, other, path in zip(leaves, shown, found)
                    ]
                    proofs = [path.translate(None, b"<>=") for path in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            members.field("id"),
                            pa.array(leaf.hex() for leaf in leaves),
                            pa.array([subroot.hex()] * size),
                            pa.array([root.hex()] * size),
                            pa.array(proofs, pa.binary()).cast(pa.string()),
                            pa.array(node.hex() for node in folded),
                            pa.array(node == root for node in folded),
                        ],
                        schema_names,
                    )

        id_type = self.leaves.schema["id"].dataType.simpleString()
        schema = (
            f"id {id_type}, leaf string, subroot string, root string, proof string, "
            "folded_root string, verified boolean"
        )
        schema_names = ["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
        return wanted.mapInArrow(work, schema)


def build(
    rows: DataFrame,
    columns: Sequence[str],
    *,
    id_col: str,
    tree_col: str,
    changed: Column | None = None,
    changes: Mapping[str, Column] | None = None,
    block_height: int = BLOCK_HEIGHT,
) -> Manifest:
    """The manifest of ``rows`` over ``columns``, with a tree for each value of ``tree_col``.

    For an audit, rows for which ``changed`` is true are also presented with ``changes``: other
    values for some columns. Other columns of ``rows`` play no part, whatever their names.
    """
    own = [F.col(name) for name in columns]
    other = [(changes or {}).get(name, F.col(name)) for name in columns]
    if changed is None:
        changed = F.lit(False)
    leaves = rows.select(
        # One sign before each name, so that NULL can stand first as an empty text.
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
        F.col(id_col).alias("id"),
        F.unhex(leaf_digest(own)).alias("digest"),
        F.unhex(F.when(changed, leaf_digest(other))).alias("presented"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Kept before it is sorted: the bounds of the ranges are drawn in a pass of their own.
    placed = _positions(keep_table(leaves), ["id", "digest", "row"]).drop("row")
    tiers = _tiers(placed.select("tree", "position", "digest", "n"), block_height)
    names = _roots(tiers, block_height).select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")
    )
    top_leaves = _positions(names, ["name"])
    top = _tiers(top_leaves.select("tree", "position", "digest", "n"), block_height)
    found = top[-1].select("root").first()
    return Manifest(placed, tiers, top_leaves, top, found and bytes(found[0]), block_height)
