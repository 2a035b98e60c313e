"""From pages to words and their contexts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import http, markup, text
from wordloom.operators.lookup import lookup


def ok_pages(pages: DataFrame) -> DataFrame:
    """Pages (seq, file_no, url, doc) with status 200, as (seq, file_no, url, body).

    A response ends at its first NUL: in the headers that leaves no header end, elsewhere it cuts the body.
    """
    kept = pages.where(_is_whole())
    return kept.select("seq", "file_no", "url", text.until_nul(http.body("doc")).alias("body"))


def _is_whole() -> Column:
    return http.is_ok("doc") & ~http.head_has_nul("doc")


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page with status 200: its URL words, then its body words."""
    return ok_pages(pages).select("seq", "file_no", "url", _page_words().alias("tokens"))


def all_page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page, ``ok`` telling whether it has status 200; the others have no tokens. The rows that are ok are ``page_tokens``."""
    flagged = pages.select("seq", "file_no", "url", "doc", F.coalesce(_is_whole(), F.lit(False)).alias("ok"))
    bodies = flagged.select("seq", "file_no", "url", "ok", F.when(F.col("ok"), text.until_nul(http.body("doc"))).alias("body"))
    return bodies.select("seq", "file_no", "url", "ok", F.when(F.col("ok"), _page_words()).alias("tokens"))


def _page_words() -> Column:
    return F.concat(text.words("url"), text.html_words("body"))


def doc_tokens(tokens: DataFrame, url_map: DataFrame, **lookup_options) -> DataFrame:
    """Page tokens with the page's document ID in place of its URL: (seq, file_no, doc_id, tokens).

    What is shuffled here, if anything, are word arrays: neither the page text nor one row per word.
    """
    return lookup(tokens, url_map, "url", "doc_id", "n_pages", "seq", **lookup_options).select(
        "seq", "file_no", "doc_id", "tokens"
    )


def exploded(tokens: DataFrame, *keep: str) -> DataFrame:
    """One row per word.

    The outer form with a filter: the plain one makes Catalyst repeat the array's expression in a filter.
    """
    return tokens.select(*keep, F.explode_outer("tokens").alias("word")).where("word IS NOT NULL")


def positions(tokens: DataFrame, *keep: str) -> DataFrame:
    """One row per word with its position from 0."""
    return tokens.select(*keep, F.posexplode_outer("tokens").alias("pos", "word")).where("word IS NOT NULL")


def segments(bodies: DataFrame) -> DataFrame:
    """(seq, seg, kind, is_open, words): each body cut before every tag that switches a context.

    ``kind`` and ``is_open`` tell what the tag at the start switches; segment 0 has none.
    """
    cut = bodies.select("seq", F.posexplode_outer(markup.pieces(F.col("body"))).alias("seg", "_piece"))
    tag = F.when(F.col("seg") > 0, markup.piece_tag(F.col("_piece")))
    return cut.select("seq", "seg", tag.alias("_tag"), markup.piece_words(F.col("_piece")).alias("words")).select(
        "seq", "seg", markup.tag_kind(F.col("_tag")).alias("kind"), markup.tag_opens(F.col("_tag")).alias("is_open"), "words"
    )


def word_contexts(pages: DataFrame) -> DataFrame:
    """(seq, word, ctx, n): occurrences of each word of a page in each context, URL words included.

    A context is one switch per kind, not a depth: the last tag of that kind sets it. The switches are carried
    along the pieces of a page inside its row; what is shuffled are counts per page, word and context.
    """
    ok = ok_pages(pages).select("seq", text.words("url").alias("_url_words"), markup.pieces(F.col("body")).alias("_pieces"))
    stated = ok.select("seq", "_url_words", "_pieces", markup.piece_states(F.col("_pieces")).alias("_states"))
    in_body = F.flatten(
        F.transform(
            F.filter(F.arrays_zip("_pieces", "_states"), lambda p: ~markup.is_on(p["_states"], "S")),
            lambda p: F.transform(markup.piece_words(p["_pieces"]), lambda w: F.struct(w.alias("word"), markup.context(p["_states"]).alias("ctx"))),
        )
    )
    in_url = F.transform("_url_words", lambda w: F.struct(w.alias("word"), F.lit(markup.IN_URL).alias("ctx")))
    found = stated.select("seq", F.explode_outer(F.concat(in_body, in_url)).alias("_found")).select("seq", "_found.word", "_found.ctx")
    return found.where("word IS NOT NULL").groupBy("seq", "word", "ctx").agg(F.count("*").alias("n"))
