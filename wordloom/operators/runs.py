"""Runs of postings: merging, compaction, roll-up."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN_ORDER = ["word_id", "doc_id"]


def by_posting(postings: DataFrame, *before: str) -> DataFrame:
    """Globally sorted by ``before``, word and document; a word's postings may span many partitions."""
    order = [*before, *RUN_ORDER]
    return postings.repartitionByRange(*order).sortWithinPartitions(*order)


def merge_runs(*runs: DataFrame) -> DataFrame:
    """All records of all runs in order; equal (word, document) pairs are kept apart."""
    return by_posting(reduce(DataFrame.unionByName, runs))


def compact_runs(runs: DataFrame, degree: int) -> DataFrame:
    """Merges every ``degree`` runs that follow each other into one, numbered from 0, and sorts each.

    Runs go by their place among the run numbers there are, gaps or not. The result has the columns of runs,
    so it can be compacted again. One task ranks the numbers alone, one row per run.
    """
    place = F.row_number().over(Window.orderBy("file_no")) - 1
    groups = runs.select("file_no").distinct().select("file_no", F.floor(place / degree).alias("_group"))
    grouped = runs.join(groups, "file_no").select(F.col("_group").alias("file_no"), "word_id", "doc_id", "tf")
    return by_posting(grouped, "file_no")


def roll_up(runs: DataFrame) -> DataFrame:
    """One posting per word and document, counts added up."""
    return runs.groupBy(*RUN_ORDER).agg(F.sum("tf").alias("tf"))
