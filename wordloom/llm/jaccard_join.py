"""Exact Jaccard self-join of documents' word shingles over Voronoi regions of pivots.

1 - Jaccard is a metric. Texts with the same shingles are one node. A node stands in the regions of its rarest
shingles, as many as it cannot share none of with a node in reach, once for each band of sizes that it can link
with; the pivot of a shingle in a band is its smallest node, and a region holds all nodes that have its pivot so. Every member is compared with its pivot. By the
triangle inequality members near the pivot are linked through it, and a member further off can only reach
those whose distance to the pivot differs by no more than the limit: it becomes a pivot for that window in
turn. Regions of more words than a task should hold are cut into parts, and their windows into blocks.

Links are counted where they are found: a pair that stands in several regions belongs to the one of the
smallest pivot, and pairs whose distances to the pivot add up to no more than the limit need no comparison. Only links that
join groups leave a task; components need no others.

The larger the input, the more texts share a rare shingle by chance. So signatures of a bit or two per shingle go to the
regions first: bits in which two of them differ are shingles that only one has. Texts follow for members that could
link with another one there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.components import components
from wordloom.llm.words import Chunk, chunks, frugal, mixed
from wordloom.plans.stages import stage

#: Counters of shingles by their hash, for an order with rare ones first; any counts give right results.
COUNTER_BITS = 23
#: A filter of nodes that keeps texts without a region from being shuffled: 4 MB, whatever the input. What it
#: lets through is met exactly afterwards.
FILTER_BITS = 25
_SLICES = 64
#: Shingles of a region's members that one task takes, on average.
REGION_SHINGLES = 1 << 20
NODES = "doc_id long, node long, n long, slice int, counts binary"
FOUND = "kind int, a long, b long, distance double"
_U = np.uint64


@dataclass(frozen=True)
class Measure:
    """Words per shingle, and the least similarity in hundredths."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many shingles hold one at least that any partner shares."""
        return n - (-(-n * self.percent // 100)) + 1

    def linked(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (a + b - both)

    @property
    def reach(self) -> float:
        return 1 - self.percent / 100


def near_duplicates(docs: DataFrame, measure: Measure = Measure(), doc_id: str = "doc_id", text: str = "text",
                    region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    component_id is the smallest doc_id that links lead to, n_links the number of other rows linked directly. A-Z is lowered; a text with fewer words than a
    shingle is one shingle, one without words (NULL, empty) has none and links with nothing. Rows with a NULL
    doc_id are linked but name no component; rows that repeat keep their rows. Shingles are 64-bit hashes, and
    so are sets. An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = stage(rows.mapInArrow(frugal(_nodes(measure)), NODES), "shingle_nodes").table
    nodes = made.where("slice IS NULL").select("doc_id", "node", "n")
    found = _links(rows, made, nodes, measure, region_shingles)
    roots = components(found.where("kind = 0").select("a", "b"))
    direct = found.where("kind = 3").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("_links"))
    named = nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("_copies"))
    rooted = named.join(roots, "node")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(
        named.join(roots.join(names, "root"), "node", "left").join(direct, "node", "left").select(
            "node", F.coalesce("component_id", "least").alias("component_id"), (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links")
        ),
        "components",
    ).table
    return nodes.join(classes, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )


def _links(rows: DataFrame, made: DataFrame, nodes: DataFrame, measure: Measure, region_shingles: int) -> DataFrame:
    """FOUND: the links that components need (kind 0), and counts of links of a node, to be added up (kind 3)."""
    shared = rows.sparkSession.sparkContext.broadcast(_counters(made))
    rare = rows.mapInArrow(frugal(_rare(measure, shared)), "shingle long, node long, n long")
    met = rare.groupBy("shingle").agg(F.min("node").alias("pivot"), F.max("node").alias("_last")).where("pivot < _last").select("shingle", "pivot")
    met = stage(met, "met_shingles").table
    # Most shingles meet no other node; those are not sent a second time.
    again = rows.mapInArrow(frugal(_rare(measure, shared, _filter(met.select(F.col("shingle").alias("node"))))), "shingle long, node long, n long")
    pairs = again.join(met, "shingle").groupBy("pivot", "node").agg(F.max("n").alias("n"))
    pairs = _of_like_size(stage(pairs, "region_nodes").table, measure)
    pairs = stage(_with_partners(rows, pairs, measure, region_shingles), "region_pairs").table
    parts = pairs.groupBy("pivot").agg(F.sum("n").alias("_n"), F.min("node").alias("centre")).select(
        "pivot", "centre", F.floor(F.col("_n") / region_shingles + 1).cast("int").alias("parts")
    )
    parts = stage(parts, "region_parts").table
    # The members may have lost the pivot by their sizes; the smallest of them then is the one to measure from.
    members = pairs.join(parts, "pivot").where("node <> centre").select(
        "pivot", "centre", "node", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "parts"
    )
    members = members.unionByName(
        parts.select("pivot", "centre", F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts")
    )
    facts = _facts(nodes, pairs)
    regions = _with_texts(rows, facts, stage(members, "region_members").table, measure)
    found = stage(regions.groupBy("pivot", "part").applyInArrow(_region(measure), FOUND), "region_links", apart=F.count_if(F.col("kind") == 1))
    links = found.table.where("kind <> 1")
    if found.measured["apart"]:
        links = links.unionByName(_between_parts(rows, nodes, facts, found.table, measure, region_shingles))
    return links


def _facts(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, _first, copies, pivots) of the nodes in regions: its smallest doc_id, its rows, and the regions that it is in.

    A node is in no more regions than it has shingles.
    """
    regions = pairs.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))
    copies = nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("_first"), F.count("*").alias("copies"))
    return stage(copies.join(regions, "node"), "region_facts").table


def _of_like_size(pairs: DataFrame, measure: Measure) -> DataFrame:
    """(pivot, node, n) of the members that have another one in their region of a size with which they could link.

    Sizes fall into strips as wide as the similarity allows, so two that link are in one strip or in neighbours.
    Strips are counted, so a region of any size is dealt with by partial sums.
    """
    width = max(-math.log(measure.percent / 100) * 1.0001, 1e-12)
    strips = pairs.withColumn("strip", F.floor(F.log("n") / width).cast("long"))
    counts = strips.groupBy("pivot", "strip").agg(F.count("*").alias("_n"))
    around = counts.select("pivot", F.explode(F.array(F.col("strip") - 1, "strip", F.col("strip") + 1)).alias("strip"), "_n")
    full = around.groupBy("pivot", "strip").agg(F.sum("_n").alias("_n")).where("_n > 1").select("pivot", "strip")
    return strips.join(full, ["pivot", "strip"]).select("pivot", "node", "n")


def _with_partners(rows: DataFrame, pairs: DataFrame, measure: Measure, region_shingles: int) -> DataFrame:
    """(pivot, node, n) of the members that could link with another one in their region, by signatures; regions in parts stay whole."""
    sizes = stage(pairs, "region_alike").table
    sizes = sizes.join(sizes.groupBy("pivot").agg((F.sum("n") < region_shingles).alias("_one")), "pivot")
    sizes = stage(sizes, "region_sizes").table
    some = sizes.where("_one").drop("_one")
    # Copies have the same signature.
    signed = rows.mapInArrow(frugal(_signed(measure, _filter(some))), "node long, signature binary").groupBy("node").agg(F.first("signature").alias("signature"))
    met = some.join(signed, "node").groupBy("pivot").applyInArrow(_partners(measure), "pivot long, node long, n long")
    return met.unionByName(sizes.where("NOT _one").select("pivot", "node", "n"))


def _with_texts(rows: DataFrame, facts: DataFrame, members: DataFrame, measure: Measure) -> DataFrame:
    """members, a stored table, with copies, pivots and texts: those of each node's smallest doc_id, so that copies are left out."""
    keyed = rows.mapInArrow(frugal(_keyed(measure, _filter(members))), "doc_id long, node long, text string")
    held = members.join(facts, "node")
    return keyed.join(held, (keyed["node"] == held["node"]) & keyed["doc_id"].eqNullSafe(held["_first"])).select(
        *[held[c] for c in [*members.columns, "copies", "pivots"]], "text"
    )


def _places(nodes: np.ndarray) -> np.ndarray:
    return (nodes.view(_U) >> _U(64 - FILTER_BITS)).astype(np.int64)


def _filter(members: DataFrame):
    """Broadcast flags of the places that members' nodes, or other hashes in their stead, have in the filter."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            flags[_places(batch.column("node").to_numpy())] = True
        packed = [pa.compress(part.tobytes(), codec="zstd", asbytes=True) for part in np.split(np.packbits(flags), _SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SLICES, dtype=np.int32)), pa.array(packed, pa.binary())], names=["slice", "flags"])

    size = (1 << FILTER_BITS) // 8 // _SLICES

    def joined(rows: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint8)
        for data in rows.column("flags"):
            total |= np.frombuffer(pa.decompress(data.as_py(), size, codec="zstd", asbytes=True), np.uint8)
        return pa.table({"slice": rows.column("slice")[:1].combine_chunks(), "flags": pa.array([total.tobytes()], pa.binary())})

    types = "slice int, flags binary"
    parts = members.select("node").mapInArrow(frugal(marked), types).groupBy("slice").applyInArrow(joined, types).collect()
    packed = {row["slice"]: np.frombuffer(row["flags"], np.uint8) for row in parts}
    flags = np.concatenate([packed.get(i, np.zeros(size, np.uint8)) for i in range(_SLICES)])
    return members.sparkSession.sparkContext.broadcast(np.unpackbits(flags).astype(bool))


# --- shingles -----------------------------------------------------------------------------------------


def sets_of(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, where each text's begin, and each text's node."""
    hashes, row = chunk.shingles(k)
    at = np.flatnonzero(row >= 0)
    hashes, row = hashes[at], row[at]
    short = np.flatnonzero((chunk.word_counts > 0) & (chunk.word_counts < k))
    if len(short):
        whole = []
        for i in short.tolist():
            h = _U(chunk.word_counts[i])
            for word in chunk.word_hashes[chunk.word_rows[i] : chunk.word_rows[i + 1]]:
                h = mixed(np.array([h]) + word)[0]
            whole.append(h)
        hashes, row = np.append(hashes, np.array(whole, _U)), np.append(row, short)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, row = hashes[new], row[new]
    starts = np.searchsorted(row, np.arange(len(chunk.starts) + 1))
    sums = np.append(_U(0), np.cumsum(mixed(hashes)))
    sizes = np.diff(starts)
    nodes = mixed(sums[starts[1:]] - sums[starts[:-1]] + sizes.astype(_U)).view(np.int64)
    return hashes, starts, nodes


def _nodes(measure: Measure):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << COUNTER_BITS, np.int32), set()
        names = ["doc_id", "node", "n", "slice", "counts"]
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                hashes, starts, nodes = sets_of(chunk, measure.words)
                new = np.array([not (n in seen or seen.add(n)) for n in nodes.tolist()], bool)
                np.add.at(counts, (hashes[np.repeat(new, np.diff(starts))] >> _U(64 - COUNTER_BITS)).astype(np.int64), 1)
                m = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first, m), pa.array(nodes), pa.array(np.diff(starts)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    names=names,
                )
        packed = [pa.compress(part.tobytes(), codec="zstd", asbytes=True) for part in np.split(counts, _SLICES)]
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(_SLICES, pa.int64())] * 3, pa.array(np.arange(_SLICES, dtype=np.int32)), pa.array(packed, pa.binary())], names=names
        )

    return made


def _counters(made: DataFrame) -> np.ndarray:
    """Sums of the tasks' counters, up to 65,535: 2^COUNTER_BITS numbers of two bytes, whatever the input."""
    size = (1 << COUNTER_BITS) // _SLICES

    def summed(rows: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for data in rows.column("counts"):
            total += np.frombuffer(pa.decompress(data.as_py(), 4 * size, codec="zstd", asbytes=True), np.int32)
        return pa.table({"slice": pa.array([rows.column("slice")[0].as_py()], pa.int32()), "total": pa.array([np.minimum(total, 65535).astype(np.uint16).tobytes()], pa.binary())})

    sums = made.where("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(summed, "slice int, total binary")
    out = np.zeros((_SLICES, size), np.uint16)
    for row in sums.collect():
        out[row["slice"]] = np.frombuffer(row["total"], np.uint16)
    return out.ravel()


def _rare(measure: Measure, shared, wanted=None):
    """(shingle, node, n) of each node's rarest shingles and bands, of those that pass the filter if one is given."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                hashes, starts, nodes = sets_of(chunk, measure.words)
                sizes = np.diff(starts)
                new = np.array([not (n in seen or seen.add(n)) for n in nodes.tolist()], bool)
                row = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((hashes, counts[(hashes >> _U(64 - COUNTER_BITS)).astype(np.int64)], row))
                kept = order[(np.arange(len(order)) - starts[row] < measure.prefix(sizes)[row]) & new[row]]
                band = np.frexp(sizes.astype(float))[1]  # sizes from 2^(band - 1) up to 2^band
                key, held = [hashes[kept] + band[row[kept]].astype(_U)], [row[kept]]
                for further in range(1, math.ceil(math.log2(100 / measure.percent)) + 1):
                    also = 100 * sizes >= measure.percent * (1 << (band + further - 1).astype(np.int64))  # could link with that band
                    more = kept[also[row[kept]]]
                    key.append(hashes[more] + (band[row[more]] + further).astype(_U))
                    held.append(row[more])
                found, held = mixed(np.concatenate(key)).view(np.int64), np.concatenate(held)
                if wanted is not None:
                    some = wanted.value[_places(found)]
                    found, held = found[some], held[some]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(nodes[held]), pa.array(sizes[held])], names=["shingle", "node", "n"])

    return made


def _signed(measure: Measure, wanted):
    """(node, signature) of nodes that pass the filter: bits by the shingles' hashes, each telling if their number is odd.

    There are more bits than shingles, and at most twice as many but for 64 at least; half as many are the halves' exclusive or.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = wanted.value, set()
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                hashes, starts, nodes = sets_of(chunk, measure.words)
                sizes = np.diff(starts)
                some = (sizes > 0) & flags[_places(nodes)]
                some &= np.array([s and not (n in seen or seen.add(n)) for n, s in zip(nodes.tolist(), some.tolist())], bool)
                at = np.flatnonzero(some)
                bits = np.maximum(64, 1 << np.frexp(sizes[at].astype(float))[1].astype(np.int64))
                ends = np.cumsum(bits)
                owner = np.repeat(np.arange(len(at)), sizes[at])
                place = (hashes[np.repeat(some, sizes)] & (bits[owner] - 1).astype(_U)).astype(np.int64) + (ends - bits)[owner]
                odd = np.packbits((np.bincount(place, minlength=bits.sum()) & 1).astype(bool)).tobytes()
                signatures = [odd[i:j] for i, j in zip(((ends - bits) // 8).tolist(), (ends // 8).tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(signatures, pa.binary())], names=["node", "signature"])

    return made


def _partners(measure: Measure):
    """The members of a region that have another one with which they could link: two sets differ in as many shingles as their signatures do in bits, or more."""

    def made(rows: pa.Table) -> pa.Table:
        n = rows.column("n").to_numpy()
        signatures = [np.frombuffer(x, np.uint8) for x in rows.column("signature").to_pylist()]
        lengths, could = np.array([len(x) for x in signatures]), np.zeros(len(n), bool)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths >= length)
            folded = np.array([np.bitwise_xor.reduce(signatures[i].reshape(-1, length), axis=0) for i in at])
            for x in np.flatnonzero(lengths[at] == length).tolist():
                apart = np.bitwise_count(folded ^ folded[x]).sum(axis=1, dtype=np.int64)
                possible = measure.linked((n[at] + n[at[x]] - apart) // 2, n[at], n[at[x]])
                possible[x] = False
                could[at[possible]] = True
                could[at[x]] |= possible.any()
        return rows.select(["pivot", "node", "n"]).filter(pa.array(could))

    return made


def _keyed(measure: Measure, wanted):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = wanted.value
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                _, starts, nodes = sets_of(chunk, measure.words)
                rows = batch.slice(chunk.first, chunk.last - chunk.first)
                full = pa.array(np.flatnonzero((np.diff(starts) > 0) & flags[_places(nodes)]))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(full), pa.array(nodes).take(full), rows.column("text").take(full)], names=["doc_id", "node", "text"]
                )

    return made


# --- regions ------------------------------------------------------------------------------------------


class Members:
    """The shingle sets of some nodes, each once, with postings by shingle; their copies and the regions that they are in."""

    def __init__(self, rows: pa.Table, k: int):
        first = dict(reversed([(node, i) for i, node in enumerate(rows.column("node").to_pylist())]))
        self.nodes = np.array(sorted(first), np.int64)
        at = pa.array([first[node] for node in self.nodes.tolist()], pa.int64())
        some = rows.take(at)
        self.sets: list[np.ndarray] = []
        for chunk in chunks(some.column("text").combine_chunks(), lower=True):
            hashes, starts, _ = sets_of(chunk, k)
            self.sets += np.split(hashes, starts[1:-1])
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.copies = some.column("copies").to_numpy()
        self._pivots = [np.sort(np.array(p, np.int64)) for p in some.column("pivots").to_pylist()]
        self._postings = None
        self._regions = None

    def elsewhere(self, x: int, pivot: int) -> np.ndarray:
        """Which members share a region of a smaller pivot with member x: pairs that belong to that region."""
        if self._regions is None:
            lower = [p[p < pivot] for p in self._pivots]
            flat = np.concatenate([np.zeros(0, np.int64), *lower])
            order = np.argsort(flat, kind="stable")
            self._regions = lower, flat[order], np.repeat(np.arange(len(lower)), [len(p) for p in lower])[order]
        lower, flat, owner = self._regions
        found = np.zeros(len(self.nodes), bool)
        for start, end in zip(np.searchsorted(flat, lower[x]), np.searchsorted(flat, lower[x], side="right")):
            found[owner[start:end]] = True
        return found

    def place(self, node: int) -> int:
        return int(np.searchsorted(self.nodes, node))

    def shared_with(self, hashes: np.ndarray) -> np.ndarray:
        """Shingles that each member shares with a sorted set."""
        if self._postings is None:
            owner = np.repeat(np.arange(len(self.sets)), self.sizes)
            flat = np.concatenate([np.zeros(0, _U), *self.sets])
            order = np.argsort(flat, kind="stable")
            self._postings = flat[order], owner[order]
        flat, owner = self._postings
        start, end = np.searchsorted(flat, hashes), np.searchsorted(flat, hashes, side="right")
        counts = end - start
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(start, counts)
        return np.bincount(owner[at], minlength=len(self.sets))


def _found(rows: list[tuple[np.ndarray, ...]]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0)] * 4
    types = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
    return pa.Table.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types)], names=["kind", "a", "b", "distance"])


def _rows(kind: int, a: int, b: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, ...]:
    return np.full(len(b), kind), np.full(len(b), a), b, distance


def _region(measure: Measure):
    """Links (kind 0) and their numbers (3) of a region; of one in parts links with the pivot, and all members' distances from it (1)."""

    def made(rows: pa.Table) -> pa.Table:
        pivot, parts = rows.column("pivot")[0].as_py(), rows.column("parts")[0].as_py()
        centre = rows.column("centre")[0].as_py()
        members = Members(rows, measure.words)
        p = members.place(centre)
        both = members.shared_with(members.sets[p])
        distance = 1 - both / (members.sizes + members.sizes[p] - both)
        others = np.arange(len(members.nodes)) != p
        near = measure.linked(both, members.sizes, members.sizes[p]) & others
        far = ~near & others
        out = [_rows(0, centre, members.nodes[near], distance[near])]
        if parts > 1:
            told = others | (rows.column("part")[0].as_py() == 0)  # the pivot is in every part
            out += [_rows(1, pivot, members.nodes[told], distance[told])]
        else:
            out += window_links(members, near, far, others, distance, measure, p)
            everyone = np.ones(len(members.nodes), bool)
            out += counted(members, pivot, everyone, everyone, distance, measure)
        return _found(out)

    return made


def counted(
    members: Members, pivot: int, left: np.ndarray, right: np.ndarray, distance: np.ndarray, measure: Measure
) -> list[tuple[np.ndarray, ...]]:
    """Numbers of links between members on the left and on the right, a pair once, of pairs that belong to the pivot's region."""
    links = np.zeros(len(members.nodes), np.int64)
    for x in np.flatnonzero(left).tolist():
        # Those on both sides meet from the lower one.
        own = right & ~members.elsewhere(x, pivot)
        own[: x + 1] &= ~left[: x + 1] | ~right[x]
        own[x] = False
        own &= np.abs(distance - distance[x]) <= measure.reach + 1e-9
        if not own.any():
            continue
        linked = own & (distance + distance[x] <= measure.reach - 1e-9)
        open_ = own & ~linked
        if open_.any():
            linked |= open_ & measure.linked(members.shared_with(members.sets[x]), members.sizes, members.sizes[x])
        links[x] += members.copies[linked].sum()
        links[linked] += members.copies[x]
    some = np.flatnonzero(links)
    return [(np.full(len(some), 3), members.nodes[some], links[some], np.zeros(len(some)))]


def window_links(
    members: Members, near: np.ndarray, far: np.ndarray, others: np.ndarray, distance: np.ndarray, measure: Measure, centre: int
) -> list[tuple[np.ndarray, ...]]:
    """Links of far members: each in turn is the pivot of those whose distance to the last pivot is like its own.

    All links are found; of those inside a group that earlier ones have joined already, none is told again.
    """
    out: list[tuple[np.ndarray, ...]] = []
    group = np.arange(len(members.nodes))
    group[near] = centre
    open_ = others.copy()
    if others.sum() < 2:
        return out
    for x in np.flatnonzero(far).tolist():
        open_[x] = False
        window = open_ & (np.abs(distance - distance[x]) <= measure.reach + 1e-9)
        if not window.any():
            continue
        both = members.shared_with(members.sets[x])
        linked = np.flatnonzero(window & measure.linked(both, members.sizes, members.sizes[x]))
        out += _joins(members, x, linked, group, distance)
    return out


def _joins(members: Members, x: int, linked: np.ndarray, group: np.ndarray, distance: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """One link of x to each group but its own that it is linked with; the groups become one."""
    names, first = np.unique(group[linked], return_index=True)
    other = names != group[x]
    if not other.any():
        return []
    ends = linked[first[other]]
    group[np.isin(group, names[other])] = group[x]
    return [_rows(0, int(members.nodes[x]), members.nodes[ends], distance[ends])]


def _between_parts(rows: DataFrame, nodes: DataFrame, facts: DataFrame, found: DataFrame, measure: Measure, region_shingles: int) -> DataFrame:
    """FOUND within the regions in parts: blocks of their members meet the blocks within their windows, each two once.

    Distances are cut into strips as wide as the reach, so a window lies in three of them.
    """
    sizes = nodes.where("n > 0").groupBy("node").agg(F.max("n").alias("n"))
    held = found.where("kind = 1").select(F.col("a").alias("pivot"), F.col("b").alias("node"), "distance").join(sizes, "node")
    held = stage(held.withColumn("strip", F.floor(F.col("distance") / max(measure.reach, 1e-9)).cast("long")), "region_strips").table
    cuts = held.groupBy("pivot", "strip").agg(F.sum("n").alias("_n")).select(
        "pivot", "strip", F.floor(F.col("_n") / (region_shingles / 2) + 1).cast("int").alias("_cuts")
    )
    cells = stage(
        held.join(cuts, ["pivot", "strip"]).select("pivot", "strip", F.pmod(F.xxhash64("node"), F.col("_cuts")).cast("int").alias("block"), "node", "distance"),
        "region_cells",
    ).table
    blocks = cells.select("pivot", "strip", "block").distinct()
    left = blocks.select("pivot", F.col("strip").alias("s"), F.col("block").alias("b"), F.explode(F.array(F.col("strip"), F.col("strip") + 1)).alias("strip"))
    meetings = stage(left.join(blocks, ["pivot", "strip"]).where("strip > s OR block >= b").select("pivot", "s", "b", F.col("strip").alias("t"), F.col("block").alias("c")), "region_meetings").table
    columns = ["pivot", "s", "b", "t", "c"]

    def side(strip: str, block: str, number: int, some: DataFrame) -> DataFrame:
        met = cells.withColumnsRenamed({"strip": strip, "block": block}).join(some, ["pivot", strip, block])
        return met.select(*columns, "node", "distance", F.lit(number).alias("side"))

    both = side("s", "b", 0, meetings).unionByName(side("t", "c", 1, meetings.where("s <> t OR b <> c")))

    def made(group: pa.Table) -> pa.Table:
        members = Members(group, measure.words)
        left, right, distance = (np.zeros(len(members.nodes), t) for t in (bool, bool, float))
        for node, number, d in zip(*(group.column(c).to_pylist() for c in ("node", "side", "distance"))):
            at = members.place(node)
            (right if number else left)[at] = True
            distance[at] = d
        if not right.any():
            right = left
        out = counted(members, group.column("pivot")[0].as_py(), left, right, distance, measure)
        groups = np.arange(len(members.nodes))
        for x in np.flatnonzero(left & (distance > 0)).tolist():
            window = right & (np.abs(distance - distance[x]) <= measure.reach + 1e-9)
            window[x] = False
            linked = np.flatnonzero(window & measure.linked(members.shared_with(members.sets[x]), members.sizes, members.sizes[x]))
            out += _joins(members, x, linked, groups, distance)
        return _found(out)

    held_texts = _with_texts(rows, facts, stage(both, "region_blocks").table, measure)
    return held_texts.groupBy(*columns).applyInArrow(made, FOUND)
