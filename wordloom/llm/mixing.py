"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words. Whole copies that each of its documents is certain to get come
first. For the rest a document has an inclusion probability p and a random u from its content; documents
go by u / (1 - u) * (1 - p) / p, the smallest first, until the rest of the target is filled: a sample of
fixed size, unequal chances between documents and sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.columns import set_aside
from wordloom.plans.stages import stage

MAX_REPEATS = 3
WEIGHTS = (5, 2, 1)
#: Bits of a rank that one pass of the search for the last document resolves.
_STEP_BITS = 12
_STEPS = 4
_RANK_BITS = 48


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) of (source, source_size), a stored table.

    Sources in code point order, NULL last, take the weights in turn. Targets share the sum of all sizes;
    none passes ``most`` times its source's size, what is over is shared again by weight. A target is thus
    min(most * size, level * weight), and the level is found by raising it until no other source stops.
    Without any size all targets are 0.
    """
    parts = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    ranged = stage(parts, "mix_sources").table
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    place = F.col("_before") + F.row_number().over(inside) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = stage(
        ranged.join(F.broadcast(offsets), "_part").select(
            "source", "source_size", F.get(cycle, (place % len(weights)).cast("int")).alias("weight")
        ),
        "mix_weights",
        size=F.sum("source_size"),
        weight=F.sum("weight"),
    )
    total, level = weighted.measured["size"] or 0, 0.0
    raised = total / weighted.measured["weight"] if weighted.measured["weight"] else 0.0
    limit = F.col("source_size") * float(most)
    while raised > level:
        level = raised
        stops = limit <= F.col("weight") * level
        full, open_ = weighted.table.agg(
            F.sum(F.when(stops, limit).otherwise(0.0)), F.sum(F.when(stops, 0.0).otherwise(F.col("weight")))
        ).first()
        raised = (total - full) / open_ if open_ else level
    target = F.least(limit, F.col("weight") * F.lit(level))
    return weighted.table.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: int = 7, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        merit: Column | None = None) -> DataFrame:
    """docs with columns size, source_size, target and copies (0 to MAX_REPEATS), every row kept.

    The size of a text is its number of words, 0 for NULL. ``merit`` weighs a document's chance among
    those of its source, 1 for all by default; merits must be positive. Reruns agree: the random numbers come from seed,
    doc_id and text, so rows that repeat both are taken or left together.
    No source: NULL is a source like others. An empty table gives an empty result. Columns of docs named like
    the new ones are replaced.

    Only (source, rank, size) is shuffled. Where a source's sample ends is found by summing sizes over
    ranges of the rank, each pass splitting the range in which the target is reached into 4096; no task
    sorts or holds a source.
    """
    made, inner = ["size", "source_size", "target", "copies"], ["_source", "_whole", "_chance", "_rest", "_rank", "_cut"]
    docs, named = set_aside(docs, made, inner, [doc_id, text, source])
    columns = docs.columns
    sized = docs.select(*columns, words_in(text).alias("size"))
    sizes = stage(
        sized.select(F.col(source).alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sizes"
    ).table
    targets = stage(source_targets(sizes), "mix_targets").table
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + 1e-12).cast("long")
    shares = targets.select(
        F.col("source").alias("_source"), "source_size", "target", whole.alias("_whole"),
        F.greatest(F.lit(0.0), ratio - whole).alias("_chance"),
        F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size")).alias("_rest"),
    )
    shared = sized.join(shares, F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
    ranked = shared.withColumn("_rank", _rank(seed, doc_id, text, F.lit(1.0) if merit is None else merit))
    facts = stage(
        ranked.where("_rest > 0 AND size > 0").select(F.col(source).alias("source"), "_rank", "size", "_rest"), "mix_ranks"
    ).table
    cut = _cuts(facts).select(F.col("source").alias("_source"), "_cut")
    met = ranked.join(cut, F.col(source).eqNullSafe(F.col("_source")), "left").drop("_source")
    extra = F.coalesce((F.col("_rank") < F.col("_cut")).cast("long"), F.lit(0).cast("long"))
    return named(met.select(
        *columns, "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("_whole") + extra).otherwise(F.lit(0)).cast("long").alias("copies"),
    ))


def _rank(seed: int, doc_id: str, text: str, merit: Column) -> Column:
    """The Pareto rank in 48 bits: odds of a random number over the odds of inclusion, squeezed to (0, 1)."""
    drawn = (F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)
    chance = F.least(F.lit(0.999999), F.greatest(F.lit(1e-6), F.col("_chance") * merit))
    odds = drawn / (1 - drawn) * (1 - chance) / chance
    return F.floor(odds / (1 + odds) * float(1 << _RANK_BITS)).cast("long")


def _cuts(facts: DataFrame) -> DataFrame:
    """(source, _cut): the sample of a source are its rows of rank under _cut.

    The cut stands after the row that brings the sum nearest to the rest; ranks that tie go together.
    """
    at = facts.groupBy("source").agg(F.first("_rest").alias("_rest")).select(
        "source", "_rest", F.lit(0).cast("long").alias("_low"), F.lit(0.0).alias("_sum"), F.lit(0.0).alias("_inside")
    )
    for step in range(_STEPS):
        width = 1 << (_RANK_BITS - _STEP_BITS * (step + 1))
        low = at.select(F.col("source").alias("_source"), "_low", "_sum")
        open_ = facts.join(low, F.col("source").eqNullSafe(F.col("_source"))).where(
            (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_low") + width * (1 << _STEP_BITS))
        )
        bins = open_.groupBy("source", F.expr(f"(_rank - _low) div {width}").alias("_bin")).agg(
            F.sum("size").alias("_size"), F.first("_low").alias("_low"), F.first("_sum").alias("_sum"), F.first("_rest").alias("_rest")
        )
        order = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = bins.withColumn("_to", F.col("_sum") + F.sum("_size").over(order))
        reached = F.col("_to") >= F.col("_rest")
        last = summed.groupBy("source").agg(
            F.min_by(F.struct("_bin", "_to", "_size"), F.when(reached, F.col("_bin"))).alias("_hit"),
            F.max_by(F.struct("_bin", "_to", "_size"), "_bin").alias("_end"),
            F.first("_low").alias("_low"), F.first("_rest").alias("_rest"),
        )
        hit = F.coalesce("_hit", "_end")
        at = stage(
            last.select(
                "source", "_rest", (F.col("_low") + hit["_bin"] * width).alias("_low"),
                (hit["_to"] - hit["_size"]).alias("_sum"), hit["_size"].cast("double").alias("_inside"),
            ),
            "mix_cuts",
        ).table
    with_last = F.abs(F.col("_sum") + F.col("_inside") - F.col("_rest")) <= F.abs(F.col("_sum") - F.col("_rest"))
    return at.select("source", (F.col("_low") + F.when(with_last, 1).otherwise(0)).alias("_cut"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: every row as often as ``mix`` takes it, with the columns of docs."""
    # mix replaces columns that are named like its own.
    others = {c: f"{c}_of_the_table" for c in docs.columns if c in ("size", "source_size", "target", "copies")}
    renamed = docs.withColumnsRenamed(others)
    found = mix(renamed, **options).where("copies > 0")
    copied = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return copied.select(*renamed.columns).toDF(*docs.columns)
