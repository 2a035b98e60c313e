"""Near-duplicate vectors by a subspace pigeonhole join: exact, with a count of every row's links.

Unit vectors link when their squared distance is within T = 2 - 2 * cosine. They are turned by a fixed
rotation, which spreads what tells them apart over all dimensions, and cut into blocks of few dimensions.
If a pair is within T, its distance in some block is within that block's share of T, so the union of the
blocks' range joins holds every pair. Each range join goes by a grid over leading dimensions of the block;
a vector also visits the cells that its range touches and that come before its own, so a pair of cells
meets once. What meets is decided in two passes: the first, over the block's coordinates alone, finds the
vectors that have a partner within the block's budget; only these bring their whole vectors to the second,
which verifies each pair by its cosine, in the first block whose budget it keeps.

Equal vectors are one node. A cell above ``CELL`` members is cut into tiles, pairs of parts of it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.components import components
from wordloom.llm.words import frugal
from wordloom.plans.stages import stage

BLOCK = 8
#: Members that a cell, or a part of one, may have at most.
CELL = 4096
_SEED = 20240601
_SLACK = 1e-9
_KEY = ["label", "dims", "part", "cell"]


def usable(vector: Column | str) -> Column:
    """The vector as doubles; NULL if it is NULL or zero or holds NULL, NaN or infinity."""
    values = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(values, lambda x: x != 0.0), values)


def rotation(dims: int) -> np.ndarray:
    """The same orthogonal matrix for all vectors with so many dimensions."""
    return np.linalg.qr(np.random.default_rng([_SEED, dims]).standard_normal((dims, dims)))[0]


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small parts stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def turned(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors after the rotation; summed in one order, so a vector has the same coordinates in every task."""
    units, matrix = _units(vectors), rotation(vectors.shape[1])
    found = np.zeros_like(units)
    for j, axis in enumerate(matrix):
        found += units[:, j : j + 1] * axis
    return found


def _within(x: np.ndarray, y: np.ndarray, budget: float) -> np.ndarray:
    """Whether rows are within a block's budget; of a pair's tasks, exactly one finds it first."""
    apart = x - y
    return (apart * apart).sum(axis=1) <= budget + _SLACK / 2


def _cuts(dims: int, block: int) -> list[slice]:
    return [slice(i, min(i + block, dims)) for i in range(0, dims, block)]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def grid_dims(n: int, dims: int, side: float, width: int) -> int:
    """Dimensions of a block that its grid cuts, for so many vectors: those that cost least.

    Each further one makes cells smaller and visits to other cells more. A row costs some two thousand times
    what a comparison of two does.
    """
    cuts = max(1.5, 2.5 / (np.sqrt(dims) * side))

    def cost(cut: int) -> float:
        # Volumes of balls of half a side's radius, over the faces that they can cross.
        touched = sum(math.comb(cut, j) * math.pi ** (j / 2) / math.gamma(j / 2 + 1) / 2**j for j in range(1, cut + 1))
        return (1 + touched / 2) * (2000 + n / (2 * cuts**cut))

    return min(range(1, width + 1), key=cost)


def _cells(points: np.ndarray, part: slice, radius: float, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, cells and whether home: each vector in its own cell and in those before it that its range touches."""
    dims, side = points.shape[1], 2 * radius * (1 + 1e-6)
    cut = grid_dims(n, dims, side, part.stop - part.start)
    at = points[:, part][:, :cut] / side
    home = np.floor(at)
    inside = at - home
    toward = np.where(inside < 0.5, -1, 1)
    gap = np.minimum(inside, 1 - inside) ** 2
    rows, cells, homes = [np.arange(len(home))], [home], [np.ones(len(home), bool)]
    for mask in range(1, 1 << cut):
        moved = [j for j in range(cut) if mask >> j & 1]
        # The first moved dimension decides the order of the two cells.
        near = np.flatnonzero((toward[:, moved[0]] < 0) & (gap[:, moved].sum(axis=1) <= 0.25))
        if len(near):
            cell_at = home[near].copy()
            cell_at[:, moved] += toward[near][:, moved]
            rows.append(near)
            cells.append(cell_at)
            homes.append(np.zeros(len(near), bool))
    return np.concatenate(rows), np.concatenate(cells).astype(">i4"), np.concatenate(homes)


def _met(nodes: DataFrame, budget: float, block: int) -> DataFrame:
    """(label, dims, part, cell, node, home, at): the coordinates of vectors in one block, once for each cell they meet."""
    out = pa.schema([("label", pa.string()), ("dims", pa.int32()), ("part", pa.int32()), ("cell", pa.binary()), ("node", pa.int64()), ("home", pa.bool_()), ("at", pa.binary())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            table = pa.table(whole)
            for dims in set(table["dims"].to_pylist()):
                same = table.filter(pc.equal(table["dims"], dims)).combine_chunks()
                points = turned(_matrix(same["v"].combine_chunks(), dims))
                label, node, counts = same["label"], same["node"].to_numpy(), same["n"].to_numpy()
                cuts = _cuts(dims, block)
                # Grids follow the label's number of vectors, the same for all of its rows.
                for n in np.unique(counts):
                    chosen = np.flatnonzero(counts == n)
                    for i, part in enumerate(cuts):
                        radius = np.sqrt(budget * (part.stop - part.start) / dims) + _SLACK
                        rows, cells, homes = _cells(points[chosen], part, radius, int(n))
                        rows = chosen[rows]
                        coordinates = points[rows, part].astype("<f8")
                        yield pa.RecordBatch.from_arrays([
                            label.take(pa.array(rows)).combine_chunks().cast(pa.string()), pa.array(np.full(len(rows), dims, np.int32)), pa.array(np.full(len(rows), i, np.int32)),
                            pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(node[rows]), pa.array(homes), pa.array([c.tobytes() for c in coordinates], pa.binary()),
                        ], schema=out)

    return nodes.select("label", "dims", "node", "n", "v").mapInArrow(frugal(meet), "label string, dims int, part int, cell binary, node long, home boolean, at binary")


def _tiled(met: DataFrame, cell: int) -> DataFrame:
    """The members with their tile (t, u) and own part p: cells above the bound meet as pairs of parts."""
    sizes = met.groupBy(*_KEY).agg(F.count("*").alias("members")).where(F.col("members") > cell)
    parts = F.ceil(F.coalesce("members", F.lit(1)) / cell).cast("int")
    own = met.join(sizes, _KEY, "left").withColumn("parts", parts).withColumn("p", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    met_by = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return own.withColumn("q", met_by).select(*met.columns, "p", F.least("p", "q").alias("t"), F.greatest("p", "q").alias("u"))


def _by_tile(rows: DataFrame, n: int, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` of each tile's rows. Tiles go to tasks in groups of some 16,000 rows, as most are small."""
    groups = F.lit(max(1, n >> 14)).cast("long")
    tile = [*_KEY, "t", "u"]

    def each(table: pa.Table) -> pa.Table:
        table = table.sort_by([(column, "ascending") for column in tile]).combine_chunks()
        edge = np.zeros(table.num_rows, bool)
        edge[0] = True
        for column in tile:
            values = table[column].combine_chunks()
            edge[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(edge)
        return pa.concat_tables([function(table.slice(i, j - i)) for i, j in zip(starts, np.append(starts[1:], table.num_rows))])

    return rows.withColumn("_group", F.pmod(F.xxhash64(*tile), groups)).groupBy("_group").applyInArrow(each, schema)


def _partners(p: np.ndarray, tile: tuple[int, int], home: np.ndarray, at: np.ndarray, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members of a tile within the block's budget, one of them at home: few hundred rows at a time."""
    left, right = np.flatnonzero(p == tile[0]), np.flatnonzero(p == tile[1])
    squares = (at * at).sum(axis=1)
    for i in range(0, len(left), 256):
        some = left[i : i + 256]
        apart = squares[some][:, None] + squares[right][None, :] - 2 * at[some] @ at[right].T
        near = (apart <= budget + _SLACK) & (home[some][:, None] | home[right][None, :])
        near &= some[:, None] < right[None, :] if tile[0] == tile[1] else True
        a, b = np.nonzero(near)
        yield some[a], right[b]


def near_vectors(vectors: DataFrame, least: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id of every row; rows link when their labels are equal and their cosine is at least ``least``.

    n_links counts the other rows linked directly; component_id is the smallest vec_id that links reach,
    the row's own included. Rows whose label is NULL or whose vector is not ``usable`` link with nothing;
    neither do vectors with different numbers of dimensions. Repeated rows are rows of their own, which
    link with each other; a NULL vec_id is counted as a link but names no component unless it is alone.
    An empty table gives an empty result. Only these three columns are read; others may have any name.
    The cosine must be over 0.5, below that the grids would hold nearly all pairs.
    """
    if not 0.5 < least < 1:
        raise ValueError("the least cosine must be between 0.5 and 1")
    budget = 2 - 2 * least
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.when(F.col(label).isNotNull(), usable(F.col(vector))).alias("v"))
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), "label", "v"), "h2": F.xxhash64(F.lit(2), "label", "v")}).withColumn("_row", F.monotonically_increasing_id())
    known = stage(rows, "vectors").table
    fit = known.where("v IS NOT NULL")
    # 128 bits stand for a vector; copies meet in the tasks that read them first.
    alike = fit.groupBy("label", "h1", "h2").agg(F.min("_row").alias("node"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    nodes = stage(alike, "vector_nodes").table
    sized = fit.select("_row", "label", "v", F.size("v").alias("dims")).join(nodes.select(F.col("node").alias("_row"), F.col("node")), "_row")
    distinct = stage(sized.select("node", "label", "dims", "v"), "distinct_vectors").table
    counts = distinct.groupBy(F.col("label").alias("_label"), F.col("dims").alias("_dims")).agg(F.count("*").alias("n"))
    counted = distinct.join(counts, (F.col("label") == F.col("_label")) & (F.col("dims") == F.col("_dims"))).select("node", "label", "dims", "v", "n")
    met = stage(_met(counted, budget, block), "vector_cells", n=F.count("*"))

    def coordinates(table: pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(table["at"].to_pylist()), "<f8").reshape(table.num_rows, -1)

    def share(table: pa.Table) -> float:
        return budget * coordinates(table).shape[1] / table["dims"][0].as_py()

    def flag(table: pa.Table) -> pa.Table:
        partnered = np.zeros(table.num_rows, bool)
        if table.num_rows > 1:
            tile = table["t"][0].as_py(), table["u"][0].as_py()
            for a, b in _partners(table["p"].to_numpy(), tile, table["home"].to_numpy(), coordinates(table), share(table)):
                partnered[a] = partnered[b] = True
        return table.select([*_KEY, "t", "u", "p", "home", "node"]).filter(pa.array(partnered))

    keys = "label string, dims int, part int, cell binary, t int, u int, p int, home boolean, node long"
    flagged = stage(_by_tile(_tiled(met.table, cell), met.measured["n"], flag, keys), "vector_candidates", n=F.count("*"))

    def verify(table: pa.Table) -> pa.Table:
        dims, part = table["dims"][0].as_py(), table["part"][0].as_py()
        raw = _matrix(table["v"].combine_chunks(), dims)
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        norms = np.sqrt((raw * raw).sum(axis=1))
        points, cuts = turned(raw), _cuts(dims, block)
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        links, group = np.zeros(len(node), np.int64), np.arange(len(node))
        told: list[tuple[int, int]] = []
        shares = [budget * (cut.stop - cut.start) / dims for cut in cuts]
        tile = table["t"][0].as_py(), table["u"][0].as_py()
        for a, b in _partners(table["p"].to_numpy(), tile, table["home"].to_numpy(), points[:, cuts[part]], shares[part]):
            for i in range(0, len(a), 1 << 15):
                x, y = a[i : i + (1 << 15)], b[i : i + (1 << 15)]
                here = _within(points[x, cuts[part]], points[y, cuts[part]], shares[part])
                for cut, earlier in zip(cuts[:part], shares):
                    here &= ~_within(points[x, cut], points[y, cut], earlier)
                x, y = x[here], y[here]
                cosine = (raw[x] * raw[y]).sum(axis=1) / (norms[x] * norms[y])
                x, y = x[cosine >= least], y[cosine >= least]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                # Components need no more than the links that join groups of this task.
                while len(new := np.flatnonzero(group[x] != group[y])):
                    j, k = x[new[0]], y[new[0]]
                    group[group == group[k]] = group[j]
                    told.append((int(node[j]), int(node[k])))
        ends = [(int(n), None, int(c)) for n, c in zip(node, links) if c] + [(a, b, 0) for a, b in told]
        return pa.table({"a": pa.array([e[0] for e in ends], pa.int64()), "b": pa.array([e[1] for e in ends], pa.int64()), "n": pa.array([e[2] for e in ends], pa.int64())})

    whole = flagged.table.join(distinct.select("node", "v"), "node").join(nodes.select("node", "copies"), "node")
    told = stage(_by_tile(whole, flagged.measured["n"], verify, "a long, b long, n long"), "vector_links").table
    direct = told.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(told.where("b IS NOT NULL").select("a", "b"))
    grouped = nodes.join(direct, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stage(grouped, "vector_groups").table
    least_ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = named.join(least_ids, "root").select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = fit.select("vec_id", "label", "h1", "h2").join(classes, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = known.where("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)
