"""A corpus from raw documents: quality rules, line dedup, near duplicates, mixing, BPE codes.

Each stage takes what the one before kept and writes it as Parquet; all but the last give the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import bpe, jaccard_join, line_dedup, mixing, quality
from wordloom.plans.stages import new_folder, stage

#: Five words a shingle and a similarity of 0.8.
NEAR = jaccard_join.Measure(words=5, percent=80)
_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the standard policy."""
    measured = docs.select(*_COLUMNS, quality.measurements(F.col("text")).alias("_found")).select(*_COLUMNS, "_found.*")
    return measured.where(quality.passes(quality.STANDARD, quality.failed_bits())).select(*_COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another document keeps; n_chars follows the text."""
    return line_dedup.dedup_lines(docs.select(*_COLUMNS)).select(*_COLUMNS[:-1], F.length("text").cast("long").alias("n_chars"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest id, rows without an id last, and the first of those that tie.

    Groups are of rows, so copies without an id or with the same id are a group too. Rows without words
    are no group and stay each.
    """
    # docs is a stored table, of which every reading numbers the rows alike.
    rows = docs.select(*_COLUMNS).withColumn("_row", F.monotonically_increasing_id())
    classes = jaccard_join.near_duplicates(rows, NEAR, doc_id="_row").select(F.col("doc_id").alias("_row"), "component_id")
    named = rows.select("_row", "doc_id").join(classes, "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = stage(named.groupBy("component_id").agg(first.alias("one")).select("one._row"), "near_kept").table
    return rows.join(kept, "_row", "left_semi").select(*_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    return mixing.mixed_rows(docs.select(*_COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Codes and their decoded text, for training and for a look at it."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, decoded="decoded")
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("jaccard_join", one_of_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: SQL can express neither the Pareto order's hash nor the BPE codes; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = new_folder(spark, f"pipeline_{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
