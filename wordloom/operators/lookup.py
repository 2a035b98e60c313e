"""Equi-joins of a large table with a dictionary whose keys may be very unevenly used."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_BYTES = 32 << 20
#: A key is hot if it has more facts than a 64th of a partition.
PARTS_PER_PARTITION = 64


def lookup(
    facts: DataFrame,
    dictionary: DataFrame,
    key: str,
    value: str,
    weight: str,
    spread: str,
    dictionary_bytes: int | None = None,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Add column ``value`` of ``dictionary`` to ``facts`` by ``key``; a fact without an entry is an error.

    ``dictionary`` should be a stored table, as its size is measured first unless ``dictionary_bytes``
    tells it. Up to ``small_bytes`` it is broadcast. Beyond that the join shuffles, and a key that has more
    than 1 / (PARTS_PER_PARTITION * partitions) of all facts (``weight`` counts them) is dealt out: its facts by
    the hash of ``spread`` to as many parts as it has such shares, its entry once to each. At most
    PARTS_PER_PARTITION * partitions keys can be that common, so the table of them, which is broadcast as
    hashes with a number, has a bound that does not depend on the data.
    """
    entries = dictionary.select(key, value)
    if dictionary_bytes is None:
        dictionary_bytes = entries.agg(entry_bytes(key)).first()[0]
    if dictionary_bytes <= small_bytes:
        joined = facts.join(F.broadcast(entries.withColumnRenamed(value, "_value")), key, "left")
    else:
        parts = hot_parts(dictionary, key, weight)
        dealt = facts.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(parts), "_hash", "left")
        dealt = dealt.withColumn("_part", F.pmod(F.xxhash64(spread), F.coalesce("_parts", F.lit(1)))).drop("_hash", "_parts")
        every = F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)).cast("long") - 1)
        copies = entries.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(parts), "_hash", "left").select(
            key, F.col(value).alias("_value"), F.explode(every).alias("_part")
        )
        joined = dealt.join(copies, [key, "_part"], "left")
    missing = F.raise_error(F.concat(F.lit(f"no {value} for {key} "), F.col(key).cast("string")))
    return joined.select(*facts.columns, F.coalesce("_value", missing.cast(dictionary.schema[value].dataType)).alias(value))


def hot_parts(dictionary: DataFrame, key: str, weight: str) -> DataFrame:
    """(_hash, _parts) of the keys with more facts than a share; keys of one hash are dealt out alike."""
    partitions = int(dictionary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = dictionary.agg(F.sum(weight)).first()[0] or 0
    share = max(1, total // (PARTS_PER_PARTITION * partitions))
    hot = dictionary.where(F.col(weight) > share)
    return hot.groupBy(F.xxhash64(key).alias("_hash")).agg(F.ceil(F.sum(weight) / share).cast("int").alias("_parts"))


def entry_bytes(key: str) -> Column:
    """Aggregate: about the memory that entries with this key take, with an ID each."""
    return F.coalesce(F.sum(F.octet_length(key) + 32), F.lit(0))
