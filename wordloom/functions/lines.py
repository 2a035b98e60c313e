"""Fixed line formats of the text outputs."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dictionary_line(first: Column | str, second: Column | str) -> Column:
    first, second = (F.col(c) if isinstance(c, str) else c for c in (first, second))
    return F.concat_ws(" ", first.cast("string"), second.cast("string"))


def list_head(word_id: str = "word_id") -> Column:
    """'12 : ' before the postings of word 12."""
    return F.concat(F.col(word_id).cast("string"), F.lit(" : "))


def partial_piece(doc_id: Column, tf: Column) -> Column:
    """'< 3 2 > ' for two occurrences in document 3."""
    return F.concat(F.lit("< "), dictionary_line(doc_id, tf), F.lit(" > "))


def global_piece(doc_id: Column, tf: Column) -> Column:
    """' 3 2' for two occurrences in document 3."""
    return F.concat(F.lit(" "), dictionary_line(doc_id, tf))
