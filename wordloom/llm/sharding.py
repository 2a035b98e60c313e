"""Shards by jump consistent hashing: no ring table, and appended shards take only the rows they must."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.plans.stages import stage

_U = np.uint64


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key (Lamping and Veach): a key moves only into a new shard, with chance 1/n."""
    key = keys.astype(np.int64).view(_U).copy()
    bucket, target = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    active = np.arange(len(key))
    while len(active):
        bucket[active] = target[active]
        key[active] = key[active] * _U(2862933555777941757) + _U(1)
        step = float(1 << 31) / ((key[active] >> _U(33)) + _U(1)).astype(np.float64)
        target[active] = ((bucket[active] + 1) * step).astype(np.int64)
        active = active[target[active] < shards]
    return bucket.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Column form of ``jump`` over a stable 64-bit key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @F.pandas_udf("int")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(jump(part.to_numpy(np.int64), shards))

    return place(key)


def stable_key(*columns: str) -> Column:
    """64 bits of the columns' values; NULL values give a key too, the same one for all."""
    return F.xxhash64(*columns)


def shards(table: DataFrame, keys: list[str], count: int, order: list[str], keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with shard, grown_shard (with one shard more) and slot.

    A row's shard depends on its ``keys`` and ``count`` alone. slot numbers the rows of a shard from 0
    without gaps, by the columns ``order`` (NULL first); rows that tie in it are numbered in any order.
    Kept columns named like these three are replaced. Rows with NULL keys share a shard. An empty table gives an empty result; repeated rows are all kept.

    Slots need no task per shard: rows are sorted by range of (shard, order), counted per range and
    shard, and each range is numbered from the sum of those before it. The ranges are stored before
    that, as a lost executor could cut them anew. Only ``keep`` is shuffled, never other columns.
    """
    kept = [c for c in keep if c not in ("shard", "grown_shard", "slot")]
    placed = table.select(
        *[F.col(c).alias(f"_kept{i}") for i, c in enumerate(kept)],
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)],
        shard_of(stable_key(*keys), count).alias("shard"),
        shard_of(stable_key(*keys), count + 1).alias("grown_shard"),
    )
    by = [f"_by{i}" for i in range(len(order))]
    ranged = placed.repartitionByRange("shard", *by, F.rand(17)).withColumn("_range", F.spark_partition_id())
    stored = stage(ranged, "shard_ranges").table
    sizes = stored.groupBy("shard", "_range").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("long")).alias("_offset")
    )
    inside = Window.partitionBy("shard", "_range").orderBy(*by)
    numbered = stored.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    return numbered.join(offsets, ["shard", "_range"], "left").select(
        *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(kept)], "shard", "grown_shard", (F.col("_offset") + F.col("_row")).alias("slot")
    )
