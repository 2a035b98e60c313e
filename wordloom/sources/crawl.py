"""Crawl archives: pairs of gzip files, an index of (URL, length) lines and the pages laid end to end."""

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wordloom.schemas import PAGE_INDEX, RAW_PAGES, SCANNED_PAGES
from wordloom.sources.files import open_gzip

PAGE_BATCH_BYTES = 16 << 20
ONE_TASK_BYTES = 1 << 30
BLOCK_LINES_BITS = 16
_ROWS = 10_000
_CHUNK = 1 << 20


#: Patterns on a path: the number of its pair, and which half of it the file is.
NUMBER = r"(\d+)_(?:index|data)$"
KIND = r"\d+_(index|data)$"


def list_pairs(spark: SparkSession, root: str, number: str = NUMBER, kind: str = KIND) -> DataFrame:
    """(file_no, index_path, data_path, data_bytes) of the files under ``root``: both halves are found by name and paired by number.

    Only names and sizes are read; ``number`` and ``kind`` are patterns on the path, with one group each, and
    files that do not fit them are none of the archive's. A number with other than one index and one data file
    fails when its row is read, and names the files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(
            F.regexp_extract("path", number, 1).try_cast("long").alias("file_no"),
            F.regexp_extract("path", kind, 1).alias("kind"),
            "path",
            "length",
        )
        .where("file_no IS NOT NULL AND kind IN ('index', 'data')")
    )

    def of(half: str, column: str):
        return F.max(F.when(F.col("kind") == half, F.col(column)))

    halves = files.groupBy("file_no").agg(
        of("index", "path").alias("index_path"),
        of("data", "path").alias("data_path"),
        of("data", "length").alias("data_bytes"),
        F.count_if(F.col("kind") == "index").alias("_index"),
        F.count_if(F.col("kind") == "data").alias("_data"),
        F.array_join(F.sort_array(F.collect_list("path")), ", ").alias("_paths"),
    )
    wrong = F.raise_error(F.concat(F.lit("archive file number "), F.col("file_no").cast("string"), F.lit(" needs one index and one data file: "), "_paths"))
    paired = (F.col("_index") == 1) & (F.col("_data") == 1)
    kinds = {"index_path": "string", "data_path": "string", "data_bytes": "long"}
    return halves.select("file_no", *[F.when(paired, F.col(c)).otherwise(wrong.cast(kind)).alias(c) for c, kind in kinds.items()])


def read_page_index(pairs: DataFrame) -> DataFrame:
    """PAGE_INDEX of the pairs, (file_no, line_no, url, length): the index files alone, one task per file."""
    rows = pairs.select("file_no", "index_path")
    return _one_task_each(rows, pairs.count()).mapInArrow(_read_index_batches, PAGE_INDEX)


def read_pairs(pairs: DataFrame, one_task_bytes: int = ONE_TASK_BYTES) -> DataFrame:
    """RAW_PAGES of the pairs, one task per pair.

    A task streams both files and holds one batch of pages. Gzip cannot be split, so a pair is always
    read by one task; pages of data files above ``one_task_bytes`` (compressed) are spread by line
    afterwards, so that what follows the scan does not depend on one task either.
    """
    is_big = F.col("data_bytes") > one_task_bytes
    counts = pairs.agg(F.count_if(~is_big).alias("small"), F.count_if(is_big).alias("big")).first()
    small = _scan(pairs.where(~is_big), counts["small"])
    if not counts["big"]:
        return small
    return small.unionByName(_scan(pairs.where(is_big), counts["big"]).repartition("file_no", "line_no"))


def scan_pairs(pairs: DataFrame) -> DataFrame:
    """SCANNED_PAGES of the pairs: every listed page, with the reason if it could not be read, in one pass.

    For crawls in which a damaged file must not end the job; ``read_pairs`` refuses them. A page is refused, its
    place, length and text as far as known, when its line or its data are damaged, and so are those behind it whose
    place depends on it. What is wrong behind the last page has a row of its own, numbered after it. One task
    reads a pair. Store the result before it is used twice.
    """
    rows = pairs.select("file_no", "index_path", "data_path")
    return _one_task_each(rows, pairs.count()).mapInArrow(_scan_batches, SCANNED_PAGES)


def good_pages(scanned: DataFrame) -> DataFrame:
    """RAW_PAGES of the pages that could be read."""
    return scanned.where("reason IS NULL").select(*RAW_PAGES.names)


def refused_pages(scanned: DataFrame) -> DataFrame:
    """(file_no, line_no, url, reason) of what could not be read."""
    return scanned.where("reason IS NOT NULL").select("file_no", "line_no", "url", "reason")


def account(scanned: DataFrame) -> DataFrame:
    """(file_no, rows, good, refused, bytes): what became of each file; rows is the sum of the next two."""
    refused = F.col("reason").isNotNull()
    return scanned.groupBy("file_no").agg(
        F.count("*").alias("rows"), F.count_if(~refused).alias("good"), F.count_if(refused).alias("refused"),
        F.coalesce(F.sum(F.when(~refused, F.col("length"))), F.lit(0)).alias("bytes"),
    )


def page_slices(page_index: DataFrame, block_bits: int = BLOCK_LINES_BITS) -> DataFrame:
    """(file_no, line_no, start_at, length): a page starts where the earlier lengths of its file end.

    Lengths are summed in blocks of 2^block_bits lines, then over the blocks of a file, so that a window
    partition stays small in a file of any size.
    """
    lines = page_index.select("file_no", "line_no", "length", F.shiftright("line_no", block_bits).alias("_block"))
    in_block = Window.partitionBy("file_no", "_block").orderBy("line_no")
    over_blocks = Window.partitionBy("file_no").orderBy("_block")
    blocks = lines.groupBy("file_no", "_block").agg(F.sum("length").alias("_sum")).select(
        "file_no", "_block", _sum_before("_sum", over_blocks).alias("_before")
    )
    return (
        lines.withColumn("_within", _sum_before("length", in_block))
        .join(blocks, ["file_no", "_block"], "left")
        .select("file_no", "line_no", (F.col("_before") + F.col("_within")).alias("start_at"), "length")
    )


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))


def _scan(pairs: DataFrame, count: int) -> DataFrame:
    rows = pairs.select("file_no", "index_path", "data_path")
    return _one_task_each(rows, count).mapInArrow(_read_batches, RAW_PAGES)


def _one_task_each(pairs: DataFrame, count: int) -> DataFrame:
    """Exactly one partition per pair: numbered in one task, as there are only names."""
    numbered = pairs.withColumn("_task", F.row_number().over(Window.orderBy("file_no")) - 1)
    return numbered.repartitionById(max(1, count), F.col("_task")).drop("_task")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in batch.to_pylist():
            yield from read_pair(pair["file_no"], pair["index_path"], pair["data_path"])


def _read_index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in batch.to_pylist():
            with open_gzip(pair["index_path"]) as index:
                entries = ((pair["file_no"], *entry) for entry in _entries(index, pair["index_path"]))
                while rows := list(islice(entries, _ROWS)):
                    yield _batch(rows, PAGE_INDEX)


def read_pair(file_no: int, index_path: str, data_path: str) -> Iterator[pa.RecordBatch]:
    """RAW_PAGES of one pair, from two streams."""
    rows, held, start = [], 0, 0
    with open_gzip(index_path) as index, open_gzip(data_path) as data:
        for line_no, url, length in _entries(index, index_path):
            doc = data.read(length)
            if len(doc) < length:
                raise ValueError(f"{data_path}: ends inside page {line_no}")
            rows.append((file_no, line_no, url, start, length, doc))
            start += length
            held += length
            if held >= PAGE_BATCH_BYTES or len(rows) >= _ROWS:
                yield _batch(rows, RAW_PAGES)
                rows, held = [], 0
        if data.read(1):
            raise ValueError(f"{data_path}: holds more bytes than {index_path} lists")
    if rows:
        yield _batch(rows, RAW_PAGES)


# Why a page was refused.
CUT_SHORT = "the data end inside the page"
FEW_COLUMNS = "the line has fewer than 4 columns"
BAD_LENGTH = "the line has no length"
NO_PLACE = "its place is not known"
BAD_DATA = "the data are damaged"
BAD_INDEX = "the index is damaged"
MORE_DATA = "there are data after the last page"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pair in batch.to_pylist():
            rows, held = [], 0
            for row in _scanned(pair["file_no"], pair["index_path"], pair["data_path"]):
                rows.append(row)
                held += len(row[5] or b"")
                if held >= PAGE_BATCH_BYTES or len(rows) >= _ROWS:
                    yield _batch(rows, SCANNED_PAGES)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, SCANNED_PAGES)


def _scanned(file_no: int, index_path: str, data_path: str) -> Iterator[tuple]:
    start, spoilt, line_no = 0, None, -1
    with open_gzip(index_path) as index, open_gzip(data_path) as data:
        try:
            for line_no, line in enumerate(_lines(index)):
                columns = [c for c in line.split(b" ") if c]
                url, length = (columns[0] if columns else None), None
                reason = spoilt
                if len(columns) < 4:
                    reason = FEW_COLUMNS
                elif not columns[3].isdigit():
                    reason = BAD_LENGTH
                else:
                    length = int(columns[3])
                if reason:
                    yield file_no, line_no, url, None, length, None, reason
                    spoilt = NO_PLACE
                    continue
                doc, reason = _page(data, length)
                yield file_no, line_no, url, start, length, None if reason else doc, reason
                spoilt, start = (NO_PLACE if reason else None), start + length
        except (OSError, EOFError) as error:
            yield file_no, line_no + 1, None, None, None, None, f"{BAD_INDEX}: {error}"
            return
        if not spoilt:
            more, reason = _page(data, 1)
            if more or reason == BAD_DATA:
                yield file_no, line_no + 1, None, start, None, None, reason if reason == BAD_DATA else MORE_DATA


def _page(data: pa.NativeFile, length: int) -> tuple[bytes, str | None]:
    """A page, or the reason why it is not whole."""
    try:
        doc = data.read(length)
    except (OSError, EOFError):
        return b"", BAD_DATA
    return doc, CUT_SHORT if len(doc) < length else None


def _entries(index: pa.NativeFile, path: str) -> Iterator[tuple[int, bytes, int]]:
    """Line number, URL (column 0) and page length (column 3) of every index line."""
    for line_no, line in enumerate(_lines(index)):
        columns = [c for c in line.split(b" ") if c]
        if len(columns) < 4:
            raise ValueError(f"{path}: line {line_no} has fewer than 4 columns")
        length = int(columns[3])
        if length < 0:
            raise ValueError(f"{path}: line {line_no} has a negative length")
        yield line_no, columns[0], length


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    fields = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)


def _lines(stream: pa.NativeFile) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(_CHUNK):
        *full, rest = (rest + chunk).split(b"\n")
        yield from full
    if rest:
        yield rest
