"""Binary runs by a list of their names: one line per file, files of 12-byte little-endian triples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import batched, groupby
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from wordloom.schemas import TRIPLES
from wordloom.sources.files import locate, qualified
from wordloom.sources.runs import TRIPLE_BYTES, read_range

FORMAT = "triple_runs"
RECORDS_PER_SPLIT = 4 << 20
#: Tasks from which on a task reads several splits.
MANY_TASKS = 1024
_NAMES = 1000
_WRITTEN = "file_no long, file string, n long, first_word int, first_doc int"


@dataclass
class Split:
    """Whole records of one file."""

    path: str
    length: int
    start: int
    step: int


@dataclass
class Splits(InputPartition):
    """What one task reads."""

    splits: list[Split]


class TripleRuns(DataSource):
    """Options: ``list``, a text file or a folder of them with a name per line, and ``split``, the records of a task at most.

    Where that makes more than MANY_TASKS tasks, a task reads as many splits as bring them near that number, but no more
    than RECORDS_PER_SPLIT records: small files and splits do not cost a task each. Names without a scheme or a leading slash are taken from the list's folder.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return TRIPLES

    def reader(self, schema: StructType) -> TripleReader:
        return TripleReader(self.options)


class TripleReader(DataSourceReader):
    def __init__(self, options):
        self.list, self.step = options["list"], TRIPLE_BYTES * int(options.get("split", RECORDS_PER_SPLIT))

    def partitions(self) -> list[Splits]:
        found: list[Split] = []
        for path, info in self._files():
            if info.type != fs.FileType.File:
                raise FileNotFoundError(f"{path}: listed, but no file")
            if info.size % TRIPLE_BYTES:
                raise ValueError(f"{path}: {info.size} bytes are no whole number of records")
            found += [Split(path, info.size, start, self.step) for start in range(0, info.size, self.step)]
        each = min(-(-len(found) // MANY_TASKS), RECORDS_PER_SPLIT * TRIPLE_BYTES // self.step)
        # Spark wants a partition
        return [Splits(_joined(part)) for part in batched(found, max(1, each))] or [Splits([])]

    def _files(self) -> Iterator[tuple[str, fs.FileInfo]]:
        """The listed names with what their file system says, asked for many at once."""
        located = [(path, *locate(path)) for path in self.names()]
        for filesystem, group in groupby(located, key=lambda file: file[1]):
            for files in batched(group, _NAMES):
                yield from zip([file[0] for file in files], filesystem.get_file_info([file[2] for file in files]))

    def names(self) -> list[str]:
        """The listed files in order, each name once per line that has it."""
        filesystem, top = locate(self.list)
        info = filesystem.get_file_info(top)
        files, folder = [top], self.list.rpartition("/")[0]
        if info.type == fs.FileType.Directory:
            entries = filesystem.get_file_info(fs.FileSelector(top))
            files, folder = sorted(e.path for e in entries if e.base_name[0] not in "._"), self.list
        lines = [line for file in files for line in filesystem.open_input_stream(file).read().decode().split("\n")]
        names = [line.strip() for line in lines if line.strip()]
        return [name if ":/" in name or name.startswith("/") else f"{folder}/{name}" for name in names]

    def read(self, partition: Splits) -> Iterator[pa.RecordBatch]:
        for split in partition.splits:
            yield from read_range(split.path, split.length, split.start, split.step)


def _joined(splits: Sequence[Split]) -> list[Split]:
    """The same records, those that follow each other in a file as one split."""
    joined: list[Split] = []
    for split in splits:
        if joined and joined[-1].path == split.path and joined[-1].start + joined[-1].step == split.start:
            joined[-1] = replace(joined[-1], step=joined[-1].step + split.step)
        else:
            joined.append(split)
    return joined


def read_listed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(word_id, doc_id, tf) of all files that the list names."""
    spark.dataSource.register(TripleRuns)
    rows = spark.read.format(FORMAT).options(list=qualified(spark, path), **options).load()
    return rows.select(*[F.col(c).cast("long").alias(c) for c in TRIPLES.names])


def write_triples(runs: DataFrame, folder: str) -> DataFrame:
    """Write sorted runs (file_no, word_id, doc_id, tf) as binary files; returns (file_no, file, n, first_word, first_doc).

    The rows returned are the list of files: store them before use. Each task writes a file for each run that it holds rows
    of, under a name of its own, so a task that runs twice leaves a file that is in no list. Values must fit 32 bits.
    """
    folder = qualified(runs.sparkSession, folder)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, top = locate(folder)
        filesystem.create_dir(top, recursive=True)
        run, stream, rows = None, None, []
        try:
            for batch in batches:
                numbers = batch.column("file_no").to_numpy()
                values = np.stack([batch.column(c).to_numpy() for c in TRIPLES.names], axis=1)
                if len(values) and (values.min() < -(1 << 31) or values.max() >= 1 << 31):
                    raise ValueError("a value of a triple does not fit 32 bits")
                cuts = np.flatnonzero(np.diff(numbers)) + 1
                for part, own in zip(np.split(values, cuts), np.split(numbers, cuts)):
                    if not len(own):
                        continue
                    if run != own[0]:
                        if stream is not None:
                            stream.close()
                        run, name = own[0], f"{own[0]}-{uuid4().hex}.run"
                        stream = filesystem.open_output_stream(f"{top}/{name}")
                        rows.append([int(run), f"{folder}/{name}", 0, int(part[0, 0]), int(part[0, 1])])
                    stream.write(np.ascontiguousarray(part, "<i4").tobytes())
                    rows[-1][2] += len(part)
        finally:
            if stream is not None:
                stream.close()
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32()]
        names = ["file_no", "file", "n", "first_word", "first_doc"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names=names)

    return runs.select("file_no", *TRIPLES.names).mapInArrow(written, _WRITTEN)


def write_list(files: DataFrame, path: str) -> None:
    """The names of stored ``write_triples`` rows, by run and first record: one small row per run and task."""
    files.orderBy("file_no", "first_word", "first_doc").select("file").coalesce(1).write.text(path)
