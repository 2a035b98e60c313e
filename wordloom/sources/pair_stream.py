"""A growing crawl as a stream: pairs of archive files in the order of their numbers.

The stream's offset is the number of the next pair. A pair is read when it and all before it are there, so
document order follows the numbers, whatever the order in which files land and whatever their times.
Files must appear complete, as by a rename.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import batched

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from wordloom.schemas import RAW_PAGES
from wordloom.sources.crawl import KIND, NUMBER, read_pair
from wordloom.sources.files import locate, qualified

FORMAT = "archive_pairs"
#: Tasks of a batch from which on a task reads several pairs, one after the other.
MANY_TASKS = 256


@dataclass
class Pair(InputPartition):
    file_no: int
    index_path: str
    data_path: str
    #: Pairs that the same task reads behind this one.
    more: tuple[Pair, ...] = ()


class ArchivePairs(DataSource):
    """Options: ``path``, ``first`` (number of the first pair, 0), and ``number`` and ``kind``, patterns as in ``list_pairs``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return RAW_PAGES

    def streamReader(self, schema: StructType) -> PairStreamReader:
        return PairStreamReader(self.options)


class PairStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.first = options["path"], int(options.get("first", 0))
        self.number, self.kind = options.get("number", NUMBER), options.get("kind", KIND)

    def initialOffset(self) -> dict:
        return {"pair": self.first}

    def latestOffset(self) -> dict:
        """After the last pair before which none is missing."""
        halves, after = self._halves(), self.first
        while set(halves.get(after, {})) == {"index", "data"}:
            after += 1
        return {"pair": after}

    def partitions(self, start: dict, end: dict) -> list[Pair]:
        halves = self._halves()
        pairs = [Pair(n, halves[n]["index"], halves[n]["data"]) for n in range(start["pair"], end["pair"])]
        each = max(1, -(-len(pairs) // MANY_TASKS))
        return [replace(first, more=tuple(more)) for first, *more in batched(pairs, each)]

    def read(self, partition: Pair) -> Iterator[pa.RecordBatch]:
        for pair in (partition, *partition.more):
            yield from read_pair(pair.file_no, pair.index_path, pair.data_path)

    def _halves(self) -> dict[int, dict[str, str]]:
        """Path of each half by file number; names and nothing else are read, and two files for one half are refused."""
        filesystem, top = locate(self.path)
        prefix = self.path.removesuffix("/")
        found: dict[int, dict[str, str]] = {}
        for entry in filesystem.get_file_info(fs.FileSelector(top, allow_not_found=True, recursive=True)):
            path = prefix + entry.path.removeprefix(top.removesuffix("/"))
            number, kind = re.search(self.number, path), re.search(self.kind, path)
            if entry.type != fs.FileType.File or not number or not kind:
                continue
            halves = found.setdefault(int(number[1]), {})
            if kind[1] in halves:
                raise ValueError(f"archive file number {number[1]} has two files for its {kind[1]}: {halves[kind[1]]}, {path}")
            halves[kind[1]] = path
        return found


def stream_pairs(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """RAW_PAGES of the pairs under ``path``, as a stream; one task per pair, or MANY_TASKS for as many as there are."""
    spark.dataSource.register(ArchivePairs)
    return spark.readStream.format(FORMAT).options(path=qualified(spark, path), **options).load()
