"""A Merkle manifest of a dataset: a tree of 16 children a node per source, and one over the sources' roots.

Trees are cut into aligned blocks of 16^height leaves. A block is one row, its nodes in van Emde Boas
layout: the levels are split at half, the upper subtree is stored first, the subtrees under it follow one
by one, and each of them is laid out in the same way. ``address`` finds a node by arithmetic alone, with no
pointers and no knowledge of the size of any cache or page; construction writes by it and a proof reads
its siblings by it. The roots of a layer's blocks are the leaves of the next layer's blocks.

Leaves are numbered by range: rows are sorted once by (tree, order), counted per range, and a row's place
follows from the ranges before it, so a source may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.words import frugal
from wordloom.plans.stages import stage

ARITY = 16
#: 4,096 leaves and 140 KB a block.
HEIGHT = 3
_DIGEST = 32
_MASK = (1 << 33) - 1
_NODE = "tree long, block long, n long, ids array<bigint>, claimed binary, nodes binary, top binary"
_PATH = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def nodes_in(levels: int) -> int:
    """Nodes of a full subtree with so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, level: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes ``index`` of a level (0 is the root) in a subtree of so many levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if level < upper:
        return address(upper, level, index)
    width = ARITY ** (level - upper)
    inside = address(levels - upper, level - upper, index % width)
    return nodes_in(upper) + index // width * nodes_in(levels - upper) + inside


def height_of(leaves: int, most: int) -> int:
    """Levels of edges that a block needs: as many as its tree, ``most`` if the tree has further blocks."""
    height = 0
    while height < most and ARITY**height < leaves:
        height += 1
    return height


def joined(digests: list[bytes]) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def laid_out(leaves: list[bytes], height: int) -> bytes:
    """All nodes over the leaves of a block, every run of 16 under one node; places without a node stay zero."""
    place = np.zeros((nodes_in(height + 1), _DIGEST), np.uint8)
    level = leaves
    for h in range(height, -1, -1):
        place[address(height + 1, h, np.arange(len(level)))] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, _DIGEST)
        level = [joined(level[i : i + ARITY]) for i in range(0, len(level), ARITY)]
    return place.tobytes()


def runs_of(nodes: bytes, height: int, leaves: int) -> list[list[str]]:
    """Per level from the leaves up, the hexadecimal digests of its nodes, each run of siblings in one string."""
    place, found = np.frombuffer(nodes, np.uint8).reshape(-1, _DIGEST), []
    for h in range(height, 0, -1):
        digests = place[address(height + 1, h, np.arange(leaves))].tobytes().hex()
        step = ARITY * 2 * _DIGEST
        found.append([digests[i : i + step] for i in range(0, len(digests), step)])
        leaves = -(-leaves // ARITY)
    return found


def siblings(runs: list[list[str]], leaf: int) -> list[tuple[str, str]]:
    """What stands left and right of the leaf, then of the nodes over it, up to the block's root."""
    found = []
    for level in runs:
        run, at = level[leaf // ARITY], leaf % ARITY * 2 * _DIGEST
        found.append((run[:at], run[at + 2 * _DIGEST :]))
        leaf //= ARITY
    return found


@dataclass(frozen=True)
class Manifest:
    """Blocks of the trees by layer, the blocks over the trees' roots by layer, (tree, n, subroot, root)."""

    blocks: list[DataFrame]
    roots: list[DataFrame]
    trees: DataFrame


def leaf_digest(*columns: Column | str) -> Column:
    """Hexadecimal sha256 of the values, each ``-`` if NULL, else its UTF-8 byte count, a colon and itself."""
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _placed(rows: DataFrame, tree: Column, order: list[Column], keep: list[str], name: str) -> DataFrame:
    """``keep``, tree (place of the tree's first row among all), pos in the tree, n of the tree."""
    rows = rows.select(tree.alias("_tree"), *[c.alias(f"_by{i}") for i, c in enumerate(order)], *keep)
    # Numbered and stored first: equal rows then have an order, so many of them can be cut by range.
    known = stage(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}_leaves").table
    by = ["_tree", *[f"_by{i}" for i in range(len(order))], "_row"]
    sorted_rows = known.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    ranged = stage(sorted_rows.withColumn("_at", at).select("_tree", *keep, F.shiftright("_at", 33).alias("_range"), (F.col("_at").bitwiseAND(_MASK)).alias("_in")), f"{name}_ranges").table
    runs = stage(ranged.groupBy("_range", "_tree").agg(F.min("_in").alias("_first"), F.count("*").alias("_size")), f"{name}_runs").table
    # One row per range: their number is that of the shuffle's partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.groupBy("_range").agg(F.sum("_size").alias("_all")).select("_range", F.coalesce(F.sum("_all").over(before), F.lit(0).cast("long")).alias("_offset"))
    whole = Window.partitionBy("_tree")
    starts = runs.join(offsets, "_range").select(
        "_range", F.col("_tree").alias("_of"), "_offset", F.min(F.col("_offset") + F.col("_first")).over(whole).alias("tree"), F.sum("_size").over(whole).alias("n")
    ).withColumnRenamed("_range", "_at")
    pos = F.col("_offset") + F.col("_in") - F.col("tree")
    same = (F.col("_range") == F.col("_at")) & F.col("_tree").eqNullSafe(F.col("_of"))
    return ranged.join(starts, same).select(*keep, "tree", pos.alias("pos"), "n")


def _blocks(leaves: DataFrame, height: int, name: str) -> DataFrame:
    """Rows of _NODE from (tree, pos, n, id, claimed, leaf); a group is one block's leaves."""
    size = ARITY**height

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        digests = table["leaf"].to_pylist()
        n = table["n"][0].as_py()
        nodes = laid_out(digests, height_of(n, height))
        claimed = b"".join(c or d for c, d in zip(table["claimed"].to_pylist(), digests))
        return pa.table({
            "tree": [table["tree"][0].as_py()], "block": [table["block"][0].as_py()], "n": [n],
            "ids": pa.array([table["id"].to_pylist()], pa.list_(pa.int64())), "claimed": [claimed], "nodes": [nodes], "top": [nodes[:_DIGEST]],
        })

    cut = leaves.select("tree", F.floor(F.col("pos") / size).alias("block"), "pos", "n", "id", "claimed", "leaf")
    return stage(cut.groupBy("tree", "block").applyInArrow(build, _NODE), name).table


def _layers(leaves: DataFrame, most: int, height: int, name: str) -> list[DataFrame]:
    """The layers of blocks over trees with at most so many leaves."""
    size, found = ARITY**height, []
    while True:
        found.append(_blocks(leaves, height, f"{name}_{len(found)}"))
        if most <= size:
            return found
        most = -(-most // size)
        leaves = found[-1].where(F.col("n") > size).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claimed"), F.col("top").alias("leaf")
        )


def build(rows: DataFrame, tree: Column, order: list[Column], row_id: Column, leaf: Column, claimed: Column | None = None, height: int = HEIGHT) -> Manifest | None:
    """The manifest of all rows, or None for an empty table.

    ``tree`` says in which tree a row is (NULL is a tree, the first), ``order`` its place there (NULL
    first); rows that tie in it are ordered by their leaf, so copies change no digest. ``leaf`` is the
    hexadecimal digest of a row's content, ``claimed`` another one that ``proofs`` folds in its stead
    (NULL: none). Nothing but these values is kept, so further columns may have any name.
    """
    rows = rows.select(
        tree.alias("tree"), *[c.alias(f"by{i}") for i, c in enumerate(order)], row_id.cast("long").alias("id"),
        F.unhex(leaf).alias("leaf"), (F.lit(None).cast("binary") if claimed is None else F.unhex(claimed)).alias("claimed"),
    )
    keep = ["id", "leaf", "claimed"]
    numbered = stage(_placed(rows, F.col("tree"), [*[F.col(f"by{i}") for i in range(len(order))], F.col("leaf")], keep, "merkle"), "merkle_placed", most=F.max("n"))
    if numbered.measured["most"] is None:
        return None
    blocks = _layers(numbered.table, numbered.measured["most"], height, "merkle_blocks")
    size = ARITY**height
    tops = [b.where(F.col("n") <= size).select("tree", "top", F.lit(i).alias("layer")) for i, b in enumerate(blocks)]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    over = subroots.select(F.col("tree").alias("id"), F.col("top").alias("leaf"), F.col("top").alias("claimed"))
    placed = stage(_placed(over, F.lit(0).cast("long"), [F.col("id")], keep, "merkle_roots"), "merkle_roots_placed", most=F.max("n"))
    roots = _layers(placed.table, placed.measured["most"], height, "merkle_root_blocks")
    return Manifest(blocks, roots, subroots)


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _descend(blocks: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """(tree, id, pos, path) of every leaf of the blocks; paths (tree, block, path) are those of their roots."""
    size = ARITY**height

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                n = len(row["ids"])
                runs = runs_of(row["nodes"], height_of(row["n"], height), n)
                steps = [[{"before": a, "after": b} for a, b in siblings(runs, i)] + row["path"] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.int64()), pa.array(row["ids"], pa.int64()), pa.array(range(row["block"] * size, row["block"] * size + n), pa.int64()), pa.array(steps, _STEPS)],
                    ["tree", "id", "pos", "path"],
                )

    return blocks.join(paths, ["tree", "block"]).select("tree", "block", "n", "ids", "nodes", "path").mapInArrow(frugal(follow), f"tree long, id long, pos long, path {_PATH}")


def _paths(layers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """(tree, block, path) of the lowest layer's blocks, from the paths of the trees' roots (tree, layer, path)."""
    found = None
    for i in range(len(layers) - 1, -1, -1):
        own = tops.where(F.col("layer") == i).select("tree", F.lit(0).cast("long").alias("block"), "path")
        found = own if found is None else own.unionByName(found)
        if i:
            found = stage(_descend(layers[i], found, height).select("tree", F.col("pos").alias("block"), "path"), "merkle_paths").table
    return found


def proofs(manifest: Manifest, height: int = HEIGHT) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, digests in hexadecimal.

    The proof is the list of siblings from the leaf to the root. ``folded_root`` is what these siblings
    make of the claimed leaf, or of the leaf itself; ``verified`` says whether that is the root.
    """
    roots = manifest.roots
    top = roots[-1].select("tree", F.lit(len(roots) - 1).alias("layer"), F.array().cast(_PATH).alias("path"))
    over = _descend(roots[0], _paths(roots, top, height), height).select(F.col("id").alias("tree"), "path")
    trees = stage(manifest.trees.join(over, "tree"), "merkle_tree_paths").table
    root = roots[-1].first()["top"]  # one value
    ends = trees.select("tree", F.col("top").alias("subroot"), "layer", "path")
    below = _paths(manifest.blocks, ends, height).join(ends.select("tree", "subroot"), "tree")

    root_hex = root.hex()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                n, h = len(row["ids"]), height_of(row["n"], height)
                runs = runs_of(row["nodes"], h, n)
                leaves = np.frombuffer(row["nodes"], np.uint8).reshape(-1, _DIGEST)[address(h + 1, h, np.arange(n))].tobytes().hex()
                claimed, subroot = row["claimed"].hex(), row["subroot"].hex()
                above = [(s["before"], s["after"]) for s in row["path"]]
                rest = "".join(a + b for a, b in above)
                digests, folded = [], []
                for i in range(n):
                    own = siblings(runs, i)
                    digests.append(sha256(("".join([a + b for a, b in own]) + rest).encode()).hexdigest())
                    at = claimed[64 * i : 64 * i + 64]
                    for a, b in own:
                        at = sha256((a + at + b).encode()).hexdigest()
                    for a, b in above:
                        at = sha256((a + at + b).encode()).hexdigest()
                    folded.append(at)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(row["ids"], pa.int64()), "leaf": [leaves[64 * i : 64 * i + 64] for i in range(n)], "subroot": [subroot] * n, "root": [root_hex] * n,
                    "proof_sha256": digests, "folded_root": folded, "verified": [f == root_hex for f in folded],
                })

    return manifest.blocks[0].join(below, ["tree", "block"]).select("n", "ids", "claimed", "nodes", "subroot", "path").mapInArrow(
        frugal(fold), "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
