"""Pages in the common form (seq, file_no, url, doc), seq being the document order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINE_BITS = 32


def from_table(table: DataFrame, seq: str, url: Column | str, doc: Column | str, pages_per_file: int = 32) -> DataFrame:
    """Pages of a table just read; runs of ``pages_per_file`` consecutive positions stand for one input file."""
    return table.select(
        F.col(seq).cast("long").alias("seq"),
        F.expr(f"{seq} div {pages_per_file}").alias("file_no"),
        (F.col(url) if isinstance(url, str) else url).alias("url"),
        (F.col(doc) if isinstance(doc, str) else doc).alias("doc"),
    )


def from_pairs(raw_pages: DataFrame) -> DataFrame:
    """Pages of crawl archives; order is file number, then line.

    Bytes become ISO-8859-1 characters one to one, so lengths and the words found stay exact.
    """
    return urls_of_pairs(raw_pages, F.decode("doc", "ISO-8859-1").alias("doc"))


def urls_of_pairs(page_index: DataFrame, *more: Column) -> DataFrame:
    """(seq, file_no, url) of archive pages, from what their index files list."""
    seq = F.shiftleft("file_no", _LINE_BITS).bitwiseOR(F.col("line_no"))
    return page_index.select(seq.alias("seq"), "file_no", F.decode("url", "ISO-8859-1").alias("url"), *more)
