"""Merkle manifest of a dataset: binary trees in blocks of a van Emde Boas layout.

The leaves of a tree are cut into aligned blocks of ``2 ** height``. A block is one
row that holds its subtree as an array of digests: the upper half of its levels first,
then every lower half from left to right, each split the same way again, so that a walk
between leaf and root touches few distant places whatever the page size. ``address`` is
the arithmetic of that order; it serves construction and the search for siblings alike.
The roots of blocks are the leaves of the next, much smaller, table of blocks.

A run of fewer nodes than two at the end of a level is hashed on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.llm.prefix import running
from starweave.llm.tables import free_name
from starweave.session import stage

#: Levels of a block above its leaves: 2,048 leaves, 4,095 digests, 131 kB.
HEIGHT = 11
#: Bytes of a digest, and of a step of a path: side of the sibling, digest.
DIGEST = 32
STEP = DIGEST + 1
#: Sides: the node is alone in its run, or its sibling stands left or right of it.
ALONE, LEFT, RIGHT = range(3)

_BLOCKS = "tree string, block long, leaves int, height int, nodes binary, root binary"
_PATHS = "tree string, block long, path binary, subroot binary, root binary"


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of one depth (0: root) in a perfect tree of so many levels."""
    place = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        depth -= upper
        place += (1 << upper) - 1 + (index >> depth) * ((1 << lower) - 1)
        index = index & ((1 << depth) - 1)
        levels = lower
    return place


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _rows(digests: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(digests)), dtype=np.uint8).reshape(-1, DIGEST)


def subtree(leaves: Sequence[bytes], height: int) -> np.ndarray:
    """The digests of a block in van Emde Boas order; places without a node stay zero."""
    nodes = np.zeros(((1 << height + 1) - 1, DIGEST), dtype=np.uint8)
    count = len(leaves)
    own = np.arange(count)
    nodes[address(height + 1, height, own)] = np.frombuffer(b"".join(leaves), dtype=np.uint8).reshape(-1, DIGEST)
    for depth in range(height - 1, -1, -1):
        left = nodes[address(height + 1, depth + 1, np.arange(0, count, 2))]
        right = nodes[address(height + 1, depth + 1, np.arange(1, count, 2))]
        texts = [x.tobytes().hex() for x in left]
        for i, x in enumerate(right):
            texts[i] += x.tobytes().hex()
        count = len(texts)
        nodes[address(height + 1, depth, np.arange(count))] = _rows([_hash(t) for t in texts])
    return nodes


def steps(nodes: np.ndarray, height: int, leaves: int) -> np.ndarray:
    """Side and sibling digest of each leaf at each level of its block, leaf level first."""
    out = np.zeros((leaves, height, STEP), dtype=np.uint8)
    count = leaves
    for up in range(height):
        own = np.arange(leaves) >> up
        sibling = own ^ 1
        there = np.flatnonzero(sibling < count)
        out[there, up, 0] = np.where(own[there] & 1, LEFT, RIGHT)
        out[there, up, 1:] = nodes[address(height + 1, height - up, sibling[there])]
        count = -(-count // 2)
    return out


def siblings(path: bytes) -> list[tuple[int, str]]:
    """The steps of a path as side and hex digest."""
    return [(path[i], path[i + 1 : i + STEP].hex()) for i in range(0, len(path), STEP)]


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for side, digest in path:
        leaf = _hash(leaf if side == ALONE else digest + leaf if side == LEFT else leaf + digest)
    return leaf


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 over the fields: ``-`` for a null, else number of UTF-8 bytes, ``:``, value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(
        F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256
    )


def _blocks_of(height: int):
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        order = np.argsort(rows["pos"].to_numpy())
        leaves = rows["digest"].take(pa.array(order)).to_pylist()
        own = height if block else min(height, (len(leaves) - 1).bit_length())
        nodes = subtree(leaves, own)
        return pa.table(
            {
                "tree": pa.array([tree], pa.string()),
                "block": pa.array([block], pa.int64()),
                "leaves": pa.array([len(leaves)], pa.int32()),
                "height": pa.array([own], pa.int32()),
                "nodes": pa.array([nodes.tobytes()], pa.binary()),
                "root": pa.array([nodes[0].tobytes()], pa.binary()),
            }
        )

    return build


def build(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Tables of blocks, lowest first, over leaves ``tree, pos`` (from 0, gapless) and binary ``digest``."""
    levels = []
    while True:
        placed = nodes.select("tree", "pos", "digest", F.shiftright("pos", height).alias("block"))
        blocks = stage(placed.groupBy("tree", "block").applyInArrow(_blocks_of(height), _BLOCKS), "blocks")
        levels.append(blocks)
        more = blocks.groupBy("tree").agg(F.max("block").alias("last")).where("last > 0")
        if more.isEmpty():
            return levels
        nodes = blocks.join(more, "tree", "left_semi").select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"))


def _finished(levels: list[DataFrame], i: int) -> DataFrame:
    """``tree, block, root`` of the trees that end in this table of blocks."""
    own = levels[i].select("tree", "block", "root")
    return own.join(levels[i + 1].select("tree").distinct(), "tree", "left_anti") if i + 1 < len(levels) else own


def roots(levels: list[DataFrame]) -> DataFrame:
    """``tree, root`` of every tree."""
    out = _finished(levels, 0)
    for i in range(1, len(levels)):
        out = out.union(_finished(levels, i))
    return out.select("tree", "root")


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A path for every leaf of a block: its own steps, then those of the block."""
    for batch in batches:
        for row in batch.to_pylist():
            n = row["leaves"]
            nodes = np.frombuffer(row["nodes"], dtype=np.uint8).reshape(-1, DIGEST)
            paths = [own.tobytes() + row["path"] for own in steps(nodes, row["height"], n)]
            columns = [
                pa.array([row["tree"]] * n, pa.string()),
                pa.array(np.arange(n) + row["first"], pa.int64()),
                pa.array(paths, pa.binary()),
                pa.array([row["subroot"]] * n, pa.binary()),
                pa.array([row["root"]] * n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "path", "subroot", "root"])


def paths(levels: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The path from each block of the lowest table to the root, with ``above`` (``tree, path, subroot, root``) at its end."""
    names = ["tree", "block", "path", "subroot", "root"]
    inner = None
    for i in range(len(levels) - 1, -1, -1):
        top = _finished(levels, i).drop("root").join(above, "tree").select(*names)
        here = top if inner is None else top.union(inner)
        if i:
            wide = levels[i].drop("root").join(here, ["tree", "block"])
            numbered = wide.withColumn("first", F.shiftleft("block", height))
            inner = stage(numbered.mapInArrow(_spread, _PATHS), "paths")
    return here


def _ungrouped(levels: list[DataFrame]) -> DataFrame:
    """``tree, root, pos``: all roots as leaves of one tree, in order of their trees."""
    ranked = running(roots(levels), F.lit(0), [F.col("tree")], upto="none", nth="nth")
    return ranked.select("tree", "root", (F.col("nth") - 1).alias("pos"))


@dataclass
class Manifest:
    """The leaves of a dataset, the blocks over them by group, and the blocks over the groups' roots."""

    rows: DataFrame
    """``row`` (struct of the columns kept), ``tree``, ``pos``, and the digests ``leaf`` and ``claimed``."""
    levels: list[DataFrame]
    groups: DataFrame
    tops: list[DataFrame]
    height: int = HEIGHT

    def root(self) -> str | None:
        """The root of the dataset; none if it has no rows."""
        found = roots(self.tops).first()
        return found and found["root"].hex()

    def prove(self, keep_siblings: bool = False) -> DataFrame:
        """The columns kept, ``leaf, subroot, root, proof_sha256, folded_root, verified``; and the siblings if asked for.

        The siblings of a leaf are found in its block and on the path of that block; the claimed leaf is
        folded with them, level by level. ``siblings`` is an array of structs (``side``: 0 alone, 1 left,
        2 right; ``digest``), leaf level first.
        """
        top = roots(self.tops).select("tree", F.lit(b"").alias("path"), F.col("root").alias("subroot"), "root")
        whole = self.tops[0].drop("root").join(paths(self.tops, top, self.height), ["tree", "block"])
        spread = whole.withColumn("first", F.shiftleft("block", self.height)).mapInArrow(_spread, _PATHS)
        above = self.groups.withColumnRenamed("root", "subroot").join(
            spread.select(F.col("block").alias("pos"), "path", "root"), "pos"
        )
        entries = paths(self.levels, stage(above.select("tree", "path", "subroot", "root"), "groups"), self.height)
        blocks = self.levels[0].drop("root").join(entries, ["tree", "block"])
        leaves = self.rows.withColumn("block", F.shiftright("pos", self.height))
        kept = self.rows.schema["row"].dataType.simpleString()
        digests = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        found = ", siblings array<struct<side: int, digest: string>>" if keep_siblings else ""
        answers = (
            leaves.groupBy("tree", "block")
            .cogroup(blocks.groupBy("tree", "block"))
            .applyInArrow(_answers_of(self.height, keep_siblings), f"row {kept}, {digests}{found}")
        )
        return answers.select("row.*", *answers.columns[1:])


def _answers_of(height: int, keep_siblings: bool):
    def answer(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        nodes = np.frombuffer(block["nodes"], dtype=np.uint8).reshape(-1, DIGEST)
        own = steps(nodes, block["height"], block["leaves"])
        above, root, subroot = siblings(block["path"]), block["root"].hex(), block["subroot"].hex()
        tail = "".join(digest for side, digest in above if side != ALONE)
        first = block["block"] << height
        proofs, folded, found = [], [], []
        for pos, claimed in zip(leaves["pos"].to_pylist(), leaves["claimed"].to_pylist(), strict=True):
            path = siblings(own[pos - first].tobytes())
            proofs.append(_hash("".join(digest for side, digest in path if side != ALONE) + tail))
            folded.append(fold(fold(claimed, path), above))
            if keep_siblings:
                found.append([{"side": side, "digest": d if side != ALONE else None} for side, d in path + above])
        n = len(proofs)
        columns = {
            "row": leaves["row"],
            "leaf": leaves["leaf"],
            "subroot": pa.array([subroot] * n, pa.string()),
            "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_()),
        }
        if keep_siblings:
            kind = pa.list_(pa.struct([("side", pa.int32()), ("digest", pa.string())]))
            columns["siblings"] = pa.array(found, kind)
        return pa.table(columns)

    return answer


def manifest(
    df: DataFrame,
    fields: Sequence[Column],
    order: Sequence[Column],
    group: Column,
    keep: Sequence[str],
    claimed: Column | None = None,
    height: int = HEIGHT,
) -> Manifest:
    """Hash every row of ``df`` to a leaf and build a tree for each ``group``, and one over the groups.

    Leaves ascend by ``order``, nulls first, ties by digest (rows that tie in both are the same leaf). Groups
    ascend by their UTF-8 bytes, the null group first. ``claimed`` is the digest that a row is verified by,
    where it isn't its own (null). An empty table has no blocks, no root and no proofs. Extra columns
    take no part. A text is read once; all that is shuffled are keys and digests.
    """
    names = free_name(df, "tree", "leaf", "claimed", *(f"order_{i}" for i in range(len(order))))
    tree, leaf, other, *keys = names
    made = (
        df.withColumns({leaf: leaf_digest(*fields), tree: F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))})
        .withColumn(other, F.coalesce(claimed, F.col(leaf)) if claimed is not None else F.col(leaf))
        .select(
            F.struct(*keep).alias("row"),
            F.col(tree).alias("tree"),
            F.col(leaf).alias("leaf"),
            F.col(other).alias("claimed"),
            *(c.alias(k) for c, k in zip(order, keys, strict=True)),
        )
    )
    ranked = running(stage(made, "leaves"), F.lit(0), [*(F.col(k) for k in keys), F.col("leaf")], [F.col("tree")], "none", "nth")
    rows = stage(ranked.select("row", "tree", (F.col("nth") - 1).alias("pos"), "leaf", "claimed"), "leaves")
    levels = build(rows.select("tree", "pos", F.unhex("leaf").alias("digest")), height)
    groups = stage(_ungrouped(levels), "groups")
    tops = build(groups.select(F.lit("").alias("tree"), "pos", F.col("root").alias("digest")), height)
    return Manifest(rows, levels, groups, tops, height)
