"""Runs of postings: Parquet tables, and files of 12-byte little-endian triples."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.schemas import RUNS, TRIPLES
from wordloom.sources.files import open_seekable

TRIPLE_BYTES = 12
_TRIPLES_PER_SPLIT = 4 << 20
_TRIPLES_PER_BATCH = 1 << 18


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs written under ``path``, (file_no, word_id, doc_id, tf)."""
    return spark.read.schema(RUNS).parquet(path)


def read_triples(spark: SparkSession, *paths: str, triples_per_split: int = _TRIPLES_PER_SPLIT) -> DataFrame:
    """(word_id, doc_id, tf) of binary run files. Long files are cut into ranges read by different tasks."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    total = files.agg(F.sum(F.ceil(F.col("length") / (TRIPLE_BYTES * triples_per_split)))).first()[0] or 0
    step = TRIPLE_BYTES * triples_per_split
    splits = files.where("length > 0").select(
        "path", "length", F.explode(F.expr(f"sequence(0L, length - 1, {step}L)")).alias("start")
    )
    return (
        splits.repartition(max(1, int(total)))
        .mapInArrow(lambda batches: _read_splits(batches, step), TRIPLES)
        .select(*[F.col(c).cast("long").alias(c) for c in TRIPLES.names])
    )


def _read_splits(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for split in batch.to_pylist():
            yield from read_range(split["path"], split["length"], split["start"], step)


def read_range(path: str, length: int, start: int, step: int) -> Iterator[pa.RecordBatch]:
    """TRIPLES from byte ``start`` of a file of ``length`` bytes, ``step`` bytes at most."""
    if length % TRIPLE_BYTES:
        raise ValueError(f"{path}: {length} bytes are no whole number of records")
    left = min(step, length - start)
    with open_seekable(path) as stream:
        stream.seek(start)
        while left:
            chunk = stream.read(min(left, _TRIPLES_PER_BATCH * TRIPLE_BYTES))
            if not chunk or len(chunk) % TRIPLE_BYTES:
                raise ValueError(f"{path}: ends before the {length} bytes listed")
            left -= len(chunk)
            records = np.frombuffer(chunk, "<i4").reshape(-1, 3)
            columns = [pa.array(np.ascontiguousarray(records[:, i])) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=TRIPLES.names)
