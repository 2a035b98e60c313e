"""URL map and lexicon: what is seen first, and the IDs that follow from it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.ids import dense_ids
from wordloom.operators.tokens import positions

URL_ORDER = ["first_seq"]
WORD_ORDER = ["first_seq", "first_pos"]


def url_firsts(pages: DataFrame) -> DataFrame:
    """(url, first_seq, n_pages) of all pages, whatever their status."""
    return pages.groupBy("url").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n_pages"))


def word_firsts(tokens: DataFrame) -> DataFrame:
    """(word, first_seq, first_pos, n_pages).

    A page's distinct words keep their order, so an index into them ranks words as their positions do
    and (page, word) is unique: no ties, and all aggregates stay in the hash aggregate.
    """
    distinct = tokens.select("seq", F.array_distinct("tokens").alias("tokens"))
    return positions(distinct, "seq").groupBy("word").agg(
        F.min("seq").alias("first_seq"), F.min_by("pos", "seq").alias("first_pos"), F.count("*").alias("n_pages")
    )


def url_map(url_firsts: DataFrame, last_seq: int | None = None) -> DataFrame:
    """(url, first_seq, n_pages, doc_id)."""
    return dense_ids(url_firsts, "doc_id", URL_ORDER, last_seq=last_seq)


def lexicon(word_firsts: DataFrame, last_seq: int | None = None) -> DataFrame:
    """(word, first_seq, first_pos, n_pages, word_id)."""
    return dense_ids(word_firsts, "word_id", WORD_ORDER, last_seq=last_seq)
