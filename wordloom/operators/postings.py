"""Postings and what is computed from them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import lines
from wordloom.functions.vbyte import vbyte_hex, vbyte_length
from wordloom.operators.lookup import lookup
from wordloom.operators.tokens import exploded

SHARD_DOCS = 1 << 16  # documents per shard of a posting list
BLOCK_PAGES_BITS = 16  # pages per window partition when a word's pages are walked in order


def postings(tokens: DataFrame, lexicon: DataFrame, **lookup_options) -> DataFrame:
    """(word_id, doc_id, tf), one row per word and document."""
    return _counted(tokens, lexicon, ["doc_id"], lookup_options).select("word_id", "doc_id", "tf")


def partial_postings(tokens: DataFrame, lexicon: DataFrame, **lookup_options) -> DataFrame:
    """(file_no, word_id, doc_id, tf), one row per file, word and document."""
    return _counted(tokens, lexicon, ["file_no", "doc_id"], lookup_options).select(
        "file_no", "word_id", "doc_id", "tf"
    )


def _counted(tokens: DataFrame, lexicon: DataFrame, keys: list[str], lookup_options: dict) -> DataFrame:
    """Occurrences per key and word; counted before the lookup, so the join sees no repeated words."""
    counts = exploded(tokens, *keys).groupBy(*keys, "word").agg(F.count("*").alias("tf"))
    return lookup(counts, lexicon, "word", "word_id", "n_pages", "doc_id", **lookup_options)


def visits(
    tokens: DataFrame, lexicon: DataFrame, by_file: bool = False, block_bits: int = BLOCK_PAGES_BITS, **lookup_options
) -> DataFrame:
    """Islands of each word's pages, (word_id, block, docs, tfs): document and count of pages in a row with one document.

    Pages are walked in blocks of 2^block_bits positions, which bounds a row however common the word is. Words are
    counted inside their page, and pages are gathered before they are sent, so that a word goes once per task and block
    and not with every page; what the lookup sends are islands. With ``by_file`` column ``file_no`` comes first and every
    file is walked on its own.
    """
    word = _list_key(by_file)
    keys = [*word[:-1], "word", "block"]
    page = [*word[:-1], "seq", "doc_id"]
    in_order = tokens.select(*page, F.sort_array("tokens").alias("_words"))
    in_runs = in_order.select(*page, "_words", _run_starts("_words", lambda w: w).alias("_starts"))
    in_page = F.transform("_starts", lambda at, i: F.struct(
        F.get("_words", at).alias("word"), (_run_end("_words", "_starts", i) - at).alias("tf")
    ))
    counted = in_runs.select(*page, F.explode_outer(in_page).alias("_found")).where("_found IS NOT NULL")
    # Three lists of numbers take a third of a list of structs; none of the values is null, so they stay side by side.
    place = F.coalesce(F.col("seq").bitwiseAND(F.lit((1 << block_bits) - 1)).cast("int"), F.lit(-1))
    pages = counted.select(
        *word[:-1], "_found.word", F.shiftright("seq", block_bits).alias("block"), place.alias("place"), "doc_id", "_found.tf"
    )
    lists = ["place", "doc_id", "tf"]
    gathered = pages.groupBy(*keys).agg(*[F.collect_list(c).alias(c) for c in lists])
    in_block = gathered.select(*keys, F.sort_array(F.arrays_zip(*lists)).alias("_pages"))
    walked = in_block.select(*keys, "_pages", _run_starts("_pages", lambda p: p["doc_id"]).alias("_starts"))
    islands = walked.select(
        *keys,
        F.transform("_starts", lambda at: F.get("_pages", at)["doc_id"]).alias("docs"),
        F.transform("_starts", lambda at, i: F.aggregate(
            F.slice("_pages", at + 1, _run_end("_pages", "_starts", i) - at), F.lit(0).cast("long"), lambda total, p: total + p["tf"]
        )).alias("tfs"),
    )
    return lookup(islands, lexicon, "word", "word_id", "n_pages", "block", **lookup_options).select(*word, "block", "docs", "tfs")


def _run_starts(column: str, of) -> Column:
    """Places from 0 in an array where ``of`` an element differs from that of the one before."""
    places = F.when(F.size(column) > 0, F.sequence(F.lit(0), F.size(column) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda at: (at == 0) | (of(F.get(column, at)) != of(F.get(column, at - 1))))


def _run_end(column: str, starts: str, i: Column) -> Column:
    return F.coalesce(F.get(starts, i + 1), F.size(column))


def revisit_postings(visits: DataFrame, by_file: bool = False) -> DataFrame:
    """(word_id, ordinal, doc_id, tf): a new posting whenever the word's previous page was another document.

    Puts the blocks of ``visits``, better a stored table, in a row: a block goes on with the posting that
    the one before ended with if the document is the same. That is decided on one row per word and block, which
    has the first and the last island: only these can be parts of one posting and are added up. The
    others pass, and blocks that have none are not sent to the places found.
    """
    word = _list_key(by_file)
    n = F.size("docs").cast("long")

    def end(at: int) -> Column:
        return F.struct(F.element_at("docs", at).alias("doc_id"), F.element_at("tfs", at).alias("tf"))

    ends = visits.select(*word, "block", n.alias("_n"), end(1).alias("_first"), end(-1).alias("_last"))
    blocks = Window.partitionBy(*word).orderBy("block")
    goes_on = F.coalesce((F.lag("_last.doc_id").over(blocks) == F.col("_first.doc_id")).cast("long"), F.lit(0))
    earlier = F.sum(F.col("_n") - F.col("_goes_on")).over(blocks.rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(earlier, F.lit(0)) - F.col("_goes_on") - 1
    placed = ends.withColumn("_goes_on", goes_on).withColumn("_offset", offset)
    key = [*word, "ordinal", "doc_id"]

    def island(nth: Column, found: str) -> Column:
        return F.struct((F.col("_offset") + nth).alias("ordinal"), F.col(f"{found}.doc_id").alias("doc_id"), F.col(f"{found}.tf").alias("tf"))

    first, last = island(F.lit(1), "_first"), island(F.col("_n"), "_last")
    both = F.when(F.col("_n") > 1, F.array(first, last)).otherwise(F.array(first))
    border = placed.select(*word, F.explode(both).alias("_at")).select(*word, "_at.*").groupBy(*key).agg(F.sum("tf").alias("tf"))
    # Every block has an offset; in a left join only these may be broadcast.
    offsets = placed.where("_n > 2").select(*word, "block", "_offset")
    inner = visits.where(n > 2).select(*word, "block", *[F.slice(c, 2, F.size(c) - 2).alias(c) for c in ("docs", "tfs")])
    inside = inner.join(offsets, [*word, "block"], "left").select(*word, "_offset", F.posexplode(F.arrays_zip("docs", "tfs")).alias("_at", "_found"))
    return inside.select(
        *word, (F.col("_offset") + F.col("_at") + 2).alias("ordinal"), F.col("_found.docs").alias("doc_id"), F.col("_found.tfs").alias("tf")
    ).unionByName(border)


def _list_key(by_file: bool) -> list[str]:
    return ["file_no", "word_id"] if by_file else ["word_id"]


def unindexed_docs(url_map: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc_id, url) of documents without a posting; asks the pages, not the postings."""
    indexed = tokens.where(F.size("tokens") > 0).select("doc_id").distinct()
    return url_map.join(indexed, "doc_id", "left_anti").select("doc_id", "url")


def _sharded(postings: DataFrame, keys: list[str], shard_docs: int, order: list[str] | None = None) -> DataFrame:
    """(*keys, shard, df, postings): (doc_id, tf) of up to ``shard_docs`` documents in document order.

    A shard bounds what one task gathers, however long the word's list is. Rows are dealt out by range of
    ``order``, (*keys, shard) by default, which serves both the grouping and a sorted output: writers sort inside the
    partitions only.
    """
    grouped = [*keys, "shard"]
    rows = postings.select(*keys, F.expr(f"doc_id div {shard_docs}").alias("shard"), "doc_id", "tf").repartitionByRange(*(order or grouped))
    return rows.groupBy(*grouped).agg(
        F.count("*").alias("df"), F.array_sort(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    )


def _joined(piece) -> Column:
    """The postings of a row in the form that ``piece`` gives one, without anything between."""
    return F.array_join(F.transform("postings", lambda p: piece(p["doc_id"], p["tf"])), "")


def posting_lists(postings: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(word_id, shard, df, postings): lists of (doc_id, tf) in document order, one per word and shard."""
    return _sharded(postings, ["word_id"], shard_docs)


def global_index_lines(postings: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(word_id, shard, line): '12 :  3 2 7 1'. A word has one line per shard that holds it.

    Lines are in ranges of shards, then words: written as a folder per shard, they make hardly more files than shards.
    """
    return _sharded(postings, ["word_id"], shard_docs, ["shard", "word_id"]).select(
        "word_id", "shard", F.concat(lines.list_head(), _joined(lines.global_piece)).alias("line")
    )


def partial_index_lines(partials: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(file_no, word_id, shard, line): '12 : < 3 2 > < 7 1 > '."""
    return _sharded(partials, ["file_no", "word_id"], shard_docs).select(
        "file_no", "word_id", "shard", F.concat(lines.list_head(), _joined(lines.partial_piece)).alias("line")
    )


def posting_bytes(postings: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(word_id, shard, df, bytes): variable-byte codes of document ID and count, in document order."""
    codes = _joined(lambda doc_id, tf: F.concat(vbyte_hex(doc_id), vbyte_hex(tf)))
    return _sharded(postings, ["word_id"], shard_docs).select("word_id", "shard", "df", F.unhex(codes).alias("bytes"))


def index_stats(url_map: DataFrame, postings: DataFrame) -> DataFrame:
    """One row: n_words, n_urls, n_postings, n_bytes.

    n_bytes is the size of the compressed index as one file: per word 4 bytes and a delimiter of 1.
    """
    per_word = postings.groupBy("word_id").agg(
        F.count("*").alias("df"), F.sum(vbyte_length(F.col("doc_id")) + vbyte_length(F.col("tf"))).alias("n")
    )
    n_urls = url_map.agg(F.count("*")).scalar()
    return per_word.agg(
        F.count("*").alias("n_words"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("n_postings"),
        F.coalesce(F.sum(F.col("n") + 5), F.lit(0)).alias("n_bytes"),
    ).select("n_words", n_urls.alias("n_urls"), "n_postings", "n_bytes")


def word_stats(postings: DataFrame) -> DataFrame:
    """(word_id, df, tf_sum, max_doc_id)."""
    return postings.groupBy("word_id").agg(
        F.count("*").alias("df"), F.sum("tf").alias("tf_sum"), F.max("doc_id").alias("max_doc_id")
    )
