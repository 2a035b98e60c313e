"""Line dedup through a sharded minimal perfect hash.

Lines become pairs of 64-bit hashes. Those found in several documents are counted by a partial
aggregate and go into shards: a minimal perfect hash leads each to its place in arrays of fingerprints,
counts and owners. Documents' lines are then sent to the shards as bare hashes and probe the arrays;
no line text is ever shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.columns import set_aside
from wordloom.llm.words import chunks, frugal, mixed, powers, prefix_hashes, span_hashes
from wordloom.plans.stages import stage

MIN_CHARS = 10
#: Lines that a shard gets on average, and beyond which its probes are split.
SHARD_LINES = 1 << 17
LINES = "doc long, no_doc boolean, text_key long, line_no int, h1 long, h2 long"
INDEX = "shard long, sizes binary, bits binary, rest binary, fingerprints binary, owners binary, counts binary"
DROPS = "doc long, no_doc boolean, text_key long, line_no int"
_U = np.uint64
_LEVELS = 48
_BYTE_VALUES = mixed(np.arange(1, 257).astype(_U) * _U(0xD6E8FEB86659FD93))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_lines: int = SHARD_LINES) -> DataFrame:
    """docs with ``text`` less its repeated lines, and columns n_lines and n_dropped.

    A line's key is the line without white space at its ends, A-Z lowered. Keys of MIN_CHARS code points
    or more that several documents hold lose their lines everywhere but in the smallest doc_id. NULL and
    empty texts are one empty line. All rows with a NULL doc_id count as one document that comes last;
    rows that repeat a doc_id are one document. Other columns stay as they are; n_lines and n_dropped are replaced.
    """
    docs, named = set_aside(docs, ["n_lines", "n_dropped"], ["_doc", "_no_doc", "_key", "_drops"], [doc_id, text])
    lines = stage(hashed_lines(docs, doc_id, text), "lines", n=F.count("*"))
    shards = max(1, -(-lines.measured["n"] // shard_lines))
    repeated = stage(repeated_lines(lines.table), "repeated_lines").table
    index = stage(build_index(repeated, shards), "line_index").table
    drops = probe(lines.table, index, repeated, shards, shard_lines)
    per_text = drops.groupBy("doc", "no_doc", "text_key").agg(F.collect_list("line_no").alias("_drops"))
    return named(_apply(docs, per_text, doc_id, text))


def hashed_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """LINES: every line whose key is long enough."""
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")).alias("doc"),
        F.col(doc_id).isNull().alias("no_doc"),
        F.xxhash64(text).alias("text_key"),
        F.col(text).alias("text"),
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True):
                ends = np.flatnonzero(chunk.data == 10)
                starts = np.append(0, ends[:-1] + 1)
                word_starts, word_ends = chunk.spans
                first, after = np.searchsorted(word_starts, starts), np.searchsorted(word_starts, ends)
                full = np.flatnonzero(after > first)
                key_starts, key_ends = word_starts[first[full]], word_ends[after[full] - 1]
                heads = np.zeros(len(chunk.data) + 1, np.int64)
                np.cumsum((chunk.data & 0xC0) != 0x80, out=heads[1:])
                long = heads[key_ends] - heads[key_starts] >= MIN_CHARS
                full, key_starts, key_ends = full[long], key_starts[long], key_ends[long]
                row = np.searchsorted(chunk.ends, starts[full])
                line_no = full - np.searchsorted(ends, chunk.starts)[row]
                held = pa.array(row + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(held) for c in ("doc", "no_doc", "text_key")],
                        pa.array(line_no.astype(np.int32)),
                        pa.array(span_hashes(prefix_hashes(chunk.data), key_starts, key_ends).view(np.int64)),
                        pa.array(_second_hashes(chunk.data, key_starts, key_ends).view(np.int64)),
                    ],
                    names=["doc", "no_doc", "text_key", "line_no", "h1", "h2"],
                )

    return rows.mapInArrow(frugal(hashed), LINES)


def _second_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Like ``span_hashes``, with other values for the bytes."""
    sums = np.zeros(len(data) + 1, _U)
    by, back = powers(len(data) + 1)
    np.cumsum(_BYTE_VALUES[data] * by[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts] ^ (ends - starts).astype(_U))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(h1, h2, owner, n) of the lines in several documents: the first document and the number of lines."""
    counted = lines.groupBy("h1", "h2").agg(
        F.min(F.when(~F.col("no_doc"), F.col("doc"))).alias("owner"),
        F.max(F.when(~F.col("no_doc"), F.col("doc"))).alias("_last"),
        F.max("no_doc").alias("_no_doc"),
        F.count("*").alias("n"),
    )
    return counted.where((F.col("owner") < F.col("_last")) | F.col("_no_doc") & F.col("owner").isNotNull()).drop(
        "_last", "_no_doc"
    )


def build_index(repeated: DataFrame, shards: int) -> DataFrame:
    """INDEX: one row of arrays per shard."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = part["h1"].to_numpy(np.int64).view(_U), part["h2"].to_numpy(np.int64)
        sizes, bits, rest, places = perfect_hash(mixed(h1 ^ mixed(h2.view(_U))))
        arrays = []
        for values in (h2, part["owner"].to_numpy(np.int64), part["n"].to_numpy(np.int64)):
            placed = np.empty(len(part), np.int64)
            placed[places] = values
            arrays.append(placed.tobytes())
        return pd.DataFrame([(part["shard"].iloc[0], sizes.tobytes(), bits.tobytes(), rest.tobytes(), *arrays)])

    return repeated.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, INDEX)


def _shard(shards: int):
    return F.pmod(F.col("h1"), F.lit(shards)).cast("long")


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes, bits, the keys that no level parts, and every key's place from 0 to n - 1.

    On each level a key that meets no other in its slot sets that bit; the others go on to the next.
    A key's place is the number of set bits before its own.
    """
    sizes, levels, slots = [], [], np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    while len(left) and len(sizes) < _LEVELS:
        size = 2 * len(left) + 1
        slot = _slot(keys[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        slots[left[alone[slot]]] = base + slot[alone[slot]]
        left = left[~alone[slot]]
        sizes.append(size)
        levels.append(alone)
        base += size
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    rank = np.cumsum(bits) - 1
    places = np.where(slots >= 0, rank[slots] if len(rank) else 0, 0)
    places[left] = int(bits.sum()) + np.arange(len(left))
    return np.array(sizes, np.int64), np.packbits(bits), keys[left], places


def look_up(keys: np.ndarray, prints: np.ndarray, index: dict) -> np.ndarray:
    """Place of each key whose fingerprint is there, else -1."""
    sizes = np.frombuffer(index["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(index["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
    held = np.frombuffer(index["fingerprints"], np.int64)
    rank = np.cumsum(bits) - 1
    places = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        slot = base + _slot(keys[open_], level, size)
        places[open_[bits[slot]]] = rank[slot[bits[slot]]]
        open_ = open_[~bits[slot]]
        base += size
    places[(places >= 0) & (held[places] != prints)] = -1
    for i, key in enumerate(np.frombuffer(index["rest"], _U), int(bits.sum())):
        places[(keys == key) & (prints == held[i])] = i
    return places


def probe(lines: DataFrame, index: DataFrame, repeated: DataFrame, shards: int, shard_lines: int) -> DataFrame:
    """DROPS: the lines that the index gives to another document.

    A shard that common lines make large is split over several tasks, each with a copy of its arrays.
    There are at most as many such shards as there are shards' worth of lines.
    """
    weights = repeated.groupBy(_shard(shards).alias("shard")).agg(F.sum("n").alias("weight"))
    split = weights.where(F.col("weight") > shard_lines).select(
        "shard", (F.col("weight") / shard_lines + 1).cast("int").alias("parts")
    )
    parts = F.coalesce("parts", F.lit(1))
    probes = (
        lines.withColumn("shard", _shard(shards))
        .join(F.broadcast(split), "shard", "left")
        .withColumn("part", F.pmod(F.hash("doc", "text_key", "line_no"), parts))
        .drop("parts")
    )
    copies = index.join(F.broadcast(split), "shard", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))

    def found(probed: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc", "no_doc", "text_key", "line_no"]
        if held.empty or probed.empty:
            return probed.iloc[:0][columns]
        row = held.iloc[0].to_dict()
        h2 = probed["h2"].to_numpy(np.int64)
        places = look_up(mixed(probed["h1"].to_numpy(np.int64).view(_U) ^ mixed(h2.view(_U))), h2, row)
        owner = np.frombuffer(row["owners"], np.int64)[places]
        other = (owner != probed["doc"].to_numpy(np.int64)) | probed["no_doc"].to_numpy(bool)
        return probed[(places >= 0) & other][columns]

    by = ["shard", "part"]
    return probes.groupBy(*by).cogroup(copies.drop("parts").groupBy(*by)).applyInPandas(found, DROPS)


def _apply(docs: DataFrame, per_text: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The second and last shuffle: texts meet the numbers of the lines they lose."""
    keyed = docs.withColumns({
        "_doc": F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")),
        "_no_doc": F.col(doc_id).isNull(),
        "_key": F.xxhash64(text),
    })
    drops = per_text.select(
        F.col("doc").alias("_doc"), F.col("no_doc").alias("_no_doc"), F.col("text_key").alias("_key"), "_drops"
    )
    met = keyed.join(drops.hint("shuffle_hash"), ["_doc", "_no_doc", "_key"], "left")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    n_lines = F.size(lines)
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.coalesce("_drops", F.array().cast("array<int>")))
    joined = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return met.select(
        *[F.when(F.col("_drops").isNull(), F.col(text)).otherwise(joined).alias(text) if c == text else F.col(c) for c in docs.columns],
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.size(kept)).cast("long").alias("n_dropped"),
    )
