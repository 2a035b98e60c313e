"""Dictionaries in hash buckets, each with a membership filter and its largest ID.

Every batch adds a part: its new entries by bucket, and one row per bucket with a Bloom filter of its keys.
Whether a later batch needs a bucket of an earlier one is asked of the filter alone, a byte or so per entry;
only where some key may be in it are the entries read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key and their number give one wrong yes in about a hundred.
BITS_PER_KEY = 10
HASHES = 7


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def _places(key: Column, words: Column) -> Column:
    """The bits that a key has in a filter of so many 64-bit words."""
    size = words.cast("long") * 64
    first, step = F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.pmod(F.pmod(first, size) + i * F.pmod(step, size), size))


def may_hold(bits: Column, key: Column) -> Column:
    """Whether the key's bits are all set: false only for keys that are not in the bucket."""
    return F.forall(
        _places(key, F.size(bits)), lambda at: F.getbit(F.get(bits, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63)).cast("int")) == 1
    )


def filters(entries: DataFrame, key: str, value: str, batch: int) -> DataFrame:
    """(batch, bucket, n, max_id, bits) of entries (bucket, key, value), bits being the filter's 64-bit words in order.

    Bits are set word by word in an aggregation that starts in each task; a bucket's words are put in order
    at the end, a byte or so per entry.
    """
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.max(value).alias("max_id")).withColumn(
        "_words", F.ceil(F.col("n") * BITS_PER_KEY / 64).cast("long")
    )
    keyed = entries.select("bucket", F.col(key).alias("_key")).join(sizes.select("bucket", "_words"), "bucket")
    placed = keyed.select("bucket", F.explode(_places(F.col("_key"), F.col("_words"))).alias("_at"))
    set_bits = placed.select("bucket", F.shiftright("_at", 6).alias("word"), F.expr("shiftleft(1L, CAST(_at & 63 AS INT))").alias("bit"))
    every = sizes.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_words") - 1)).alias("word"), F.lit(0).cast("long").alias("bit"))
    words = set_bits.unionByName(every).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bit"))
    listed = words.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bit"))), lambda w: w["bit"]).alias("bits"))
    return sizes.join(listed, "bucket").select(F.lit(batch).cast("long").alias("batch"), "bucket", "n", "max_id", "bits")


def asked(keys: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """(batch, bucket, n) of the buckets that may hold some of the keys (bucket, key), by their filters."""
    held = known.select("batch", F.col("bucket").alias("_bucket"), "n", "bits")
    met = keys.join(held, (F.col("bucket") == F.col("_bucket")) & may_hold(F.col("bits"), F.col(key)))
    return met.select("batch", "bucket", "n").distinct()
