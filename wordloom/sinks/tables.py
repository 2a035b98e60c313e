"""Parquet tables of postings and posting lists, sorted by range so that no task holds a whole hot word."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.runs import by_posting, compact_runs


def write_postings(postings: DataFrame, path: str) -> None:
    by_posting(postings).write.mode("overwrite").parquet(path)


def write_runs(partials: DataFrame, path: str) -> None:
    """One run per input file, sorted by word and document."""
    by_posting(partials, "file_no").write.mode("overwrite").partitionBy("file_no").parquet(path)


def write_compacted(runs: DataFrame, degree: int, path: str) -> DataFrame:
    """Merge every ``degree`` runs into one, folder file_no=<n>; returns the (file_no, file) list.

    ``read_runs`` of the folder gives the next pass its runs. The list comes from the folder, not from the rows.
    """
    compact_runs(runs, degree).write.mode("overwrite").partitionBy("file_no").parquet(path)
    files = runs.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("file_no").cast("long").alias("file_no"), F.col("path").alias("file"))


def write_lists(lists: DataFrame, path: str) -> None:
    """Posting lists or their byte codes, sorted by word and shard; they are in such ranges already."""
    lists.sortWithinPartitions("word_id", "shard").write.mode("overwrite").parquet(path)
