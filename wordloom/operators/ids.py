"""Dense IDs in first-seen order, without a sort of all keys in one task.

Positions are cut into blocks of 2^BLOCK_BITS consecutive documents. Keys are ranked inside the block
that first shows them, and a block's offset is the number of keys in earlier blocks. Offsets are summed
over a tree in which a node has at most 2^FAN_BITS children and whose depth follows from the largest
position, so no window partition grows with the data: a block holds the words of a fixed number of
documents, every node above it, the root too, 65,536 rows at most.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 8
FAN_BITS = 16


def dense_ids(
    firsts: DataFrame, id_column: str, order: list[str], start: int = 0, last_seq: int | None = None
) -> DataFrame:
    """Number the rows of ``firsts`` from ``start`` in the order of the columns ``order``, document position first.

    ``firsts`` should be a stored table: it is read for the ranks, for the block sizes, and for the largest
    position unless ``last_seq`` tells it.
    """
    if last_seq is None:
        last_seq = firsts.agg(F.max(order[0])).first()[0] or 0
    in_block = Window.partitionBy("_block").orderBy(*order)
    blocked = firsts.withColumn("_block", F.shiftright(order[0], BLOCK_BITS))
    ranked = blocked.withColumn("_rank", F.row_number().over(in_block).cast("long") - 1)
    sizes = blocked.groupBy("_block").agg(F.count("*").alias("_size"))
    new_id = F.col("_offset") + F.col("_rank") + start
    # A left join, though every block has an offset: only the offsets may be broadcast then, never the keys.
    return ranked.join(_offsets(sizes, last_seq.bit_length() - BLOCK_BITS), "_block", "left").select(
        *firsts.columns, new_id.alias(id_column)
    )


def _offsets(sizes: DataFrame, bits: int) -> DataFrame:
    """Number of keys before each block."""
    if bits <= FAN_BITS:
        return sizes.select("_block", _sum_before(Window.orderBy("_block")).alias("_offset"))
    in_parent = Window.partitionBy("_parent").orderBy("_block")
    children = sizes.withColumn("_parent", F.shiftright("_block", FAN_BITS))
    parents = children.groupBy("_parent").agg(F.sum("_size").alias("_size"))
    before_parent = _offsets(parents.withColumnRenamed("_parent", "_block"), bits - FAN_BITS).select(
        F.col("_block").alias("_parent"), F.col("_offset").alias("_before")
    )
    return (
        children.withColumn("_within", _sum_before(in_parent))
        .join(before_parent, "_parent", "left")
        .select("_block", (F.col("_before") + F.col("_within")).alias("_offset"))
    )


def _sum_before(window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("long"))
