"""

Pages have no HTTP header, so the queries put one in front. ``page_id`` is the document order and 32
consecutive pages stand for one input file. Two entries give pages with a '#' in their URL status 404.
"""

from __future__ import annotations

import importlib
import importlib.util
import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions import http, text
from wordloom.operators import postings, runs, tokens
from wordloom.plans.index_build import Index
from wordloom.plans.stages import new_folder, side_by_side, stage
from wordloom.sinks import tables
from wordloom.sinks import text as text_sinks
from wordloom.sources import crawl, pair_stream, run_list
from wordloom.sources import runs as run_sources
from wordloom.sources.pages import from_pairs, from_table, urls_of_pairs
from wordloom.streaming import index_stream

HEADER = "\r\nServer: x\r\n\r\n"
COMPACTION_DEGREE = 3
SMALL_SHARD = 16
STREAM_BATCHES = 10
TIERED_BATCHES = 20
DICTIONARY_BUCKETS = 16
PAGES_END_TO_END = 64
VARIED_TAGS = [("b", "i"), ("b", "EM"), ("b", "strong"), ("h1", "h2"), ("h1", "H6"), ("b", "script")]


# --- inputs -----------------------------------------------------------------------------------------


def _response(status, html: str = "html"):
    return F.concat(F.lit("HTTP/1.1 "), status, F.lit(HEADER), F.col(html))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str, url="url") -> DataFrame:
    """All pages, all of them with status 200."""
    return from_table(_table(spark, sf_dir, "pages"), "page_id", url, _response(F.lit("200 OK")))


def _mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.contains(F.col("url"), F.lit("#")), "404 Not Found").otherwise("200 OK")
    return from_table(_table(spark, sf_dir, "pages"), "page_id", "url", _response(status))


def _site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages known by their site and section only, so that URLs come back."""
    return _pages(spark, sf_dir, F.regexp_replace("url", "/[0-9]+.*", ""))


def _document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages of few URLs, each met very often."""
    url = F.concat_ws("/", "source", "lang")
    return from_table(_table(spark, sf_dir, "documents"), "doc_id", url, _response(F.lit("200 OK"), "text"))


# --- pages and words --------------------------------------------------------------------------------


def _odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with a NUL in the body or the headers, another protocol, no or another header end, blanks, no number."""
    end, html = F.lit("\r\n\r\n"), F.col("html")
    kinds = [
        F.concat(F.lit("HTTP/1.1 200 OK"), end, F.substring(html, 1, 40), F.lit("\0"), html),
        F.concat(F.lit("HTTP/1.1 200 OK\0"), end, html),
        F.concat(F.lit("ICY 200 OK"), end, html),
        F.concat(F.lit("HTTP/1.1 200 OK\r\n"), F.translate(html, "\r\n", "  ")),
        F.concat(F.lit("http/1.0   200"), end, html),
        F.concat(F.lit("HTTP/1.1 200 OK\n\n"), F.translate(html, "\r\n", "  ")),
        F.concat(F.lit("HTTP/1.1 none"), end, html),
    ]
    doc = F.get(F.array(*kinds), (F.col("page_id") % len(kinds)).cast("int"))
    return from_table(_table(spark, sf_dir, "pages"), "page_id", "url", doc)


def page_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(_mixed_pages(spark, sf_dir))


def odd_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(_odd_pages(spark, sf_dir))


def _status(pages: DataFrame) -> DataFrame:
    pages = pages.withColumn("doc", text.until_nul("doc"))
    return pages.select(
        F.col("seq").alias("page_id"),
        http.status("doc").alias("status"),
        http.is_ok("doc").alias("is_ok"),
        F.length(http.body("doc")).cast("long").alias("body_len"),
    )


def page_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _table(spark, sf_dir, "pages").select(
        F.expr("page_id div 32").alias("file_no"),
        F.col("page_id").alias("line_no"),
        F.octet_length("html").cast("long").alias("length"),
    )
    return crawl.page_slices(index).withColumnRenamed("line_no", "page_id")


_PAIR_NUMBER, _PAIR_KIND = r"file_no=(\d+)/[^_.]", r"/(index|data)/file_no="


def _write_pairs(pages: DataFrame, root: str) -> None:
    """The pages written as gzip pairs, a response ending in the line feed the text writer adds."""
    pages = pages.withColumn("length", F.octet_length("doc") + 1)
    line = F.concat_ws(" ", "url", F.lit("0 0"), F.col("length").cast("string"))
    for kind, value in (("index", line), ("data", F.col("doc"))):
        pages.repartition("file_no").sortWithinPartitions("file_no", "seq").select("file_no", value).write.mode("append").partitionBy(
            "file_no"
        ).option("compression", "gzip").text(f"{root}/{kind}")


def _pairs(spark: SparkSession, pages: DataFrame) -> DataFrame:
    root = new_folder(spark, "pairs")
    _write_pairs(pages, root)
    return crawl.list_pairs(spark, root, _PAIR_NUMBER, _PAIR_KIND)


def pair_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.read_pairs(_pairs(spark, _pages(spark, sf_dir))).select(
        "file_no",
        "line_no",
        F.decode("url", "ISO-8859-1").alias("url"),
        "start_at",
        "length",
        F.md5("doc").alias("doc_md5"),
    )


def _damaged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of which three in four are damaged: a page cut short, a line without its columns, data after the last page."""
    root = new_folder(spark, "damaged")
    in_file = Window.partitionBy("file_no")
    pages = _pages(spark, sf_dir).withColumn("last", F.col("seq") == F.max("seq").over(in_file)).withColumn("line_no", F.expr("seq % 32"))
    kind = F.col("file_no") % 4
    length = F.octet_length("doc") + 1 + F.when(F.col("last") & (kind == 1), 7).otherwise(0)
    line = F.when((kind == 2) & (F.col("line_no") == 2), F.col("url")).otherwise(F.concat_ws(" ", "url", F.lit("0 0"), length.cast("string")))
    data = F.concat("doc", F.when(F.col("last") & (kind == 3), F.lit("\nmore")).otherwise(F.lit("")))
    for name, value in (("index", line), ("data", data)):
        pages.repartition("file_no").sortWithinPartitions("file_no", "seq").select("file_no", value).write.partitionBy("file_no").option(
            "compression", "gzip"
        ).text(f"{root}/{name}")
    return stage(crawl.scan_pairs(crawl.list_pairs(spark, root, _PAIR_NUMBER, _PAIR_KIND)), "scanned").table


def refused_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.refused_pages(_damaged_scan(spark, sf_dir)).select("file_no", "line_no", "reason")


def archive_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.account(_damaged_scan(spark, sf_dir)).drop("bytes")


def _positions(exploded: DataFrame) -> DataFrame:
    return exploded.select(F.col("seq").alias("page_id"), F.col("pos").cast("long").alias("pos"), "word")


def url_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), text.words("url").alias("tokens"))
    return _positions(tokens.positions(words, "seq"))


def body_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = tokens.ok_pages(_pages(spark, sf_dir))
    return _positions(tokens.positions(bodies.select("seq", text.html_words("body").alias("tokens")), "seq"))


def tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = tokens.ok_pages(_pages(spark, sf_dir))
    return tokens.segments(bodies).where("kind IS NOT NULL").select(
        F.col("seq").alias("page_id"), F.col("seg").cast("long").alias("seg"), "kind", "is_open"
    )


def varied_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tags that the pages lack, in place of those they have."""
    html = F.col("html")
    for i, (old, new) in enumerate(VARIED_TAGS):
        swapped = F.replace(F.replace(html, F.lit(f"<{old}>"), F.lit(f"<{new}>")), F.lit(f"</{old}>"), F.lit(f"</{new}>"))
        html = F.when(F.col("page_id") % len(VARIED_TAGS) == i, swapped).otherwise(html)
    varied = _table(spark, sf_dir, "pages").withColumn("html", html)
    pages = from_table(varied, "page_id", "url", _response(F.lit("200 OK")))
    return tokens.word_contexts(pages).withColumnRenamed("seq", "page_id")


def token_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.word_contexts(_pages(spark, sf_dir)).withColumnRenamed("seq", "page_id")


def long_page_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages put end to end, so that a page has the tags of many."""
    ends = F.array_sort(F.collect_list(F.struct("page_id", "html")))
    joined = _table(spark, sf_dir, "pages").groupBy(F.expr(f"page_id div {PAGES_END_TO_END}").alias("page_id")).agg(
        F.min_by("url", "page_id").alias("url"), F.array_join(F.transform(ends, lambda p: p["html"]), "").alias("html")
    )
    pages = from_table(joined, "page_id", "url", _response(F.lit("200 OK")))
    return tokens.word_contexts(pages).withColumnRenamed("seq", "page_id")


# --- dictionaries -----------------------------------------------------------------------------------


def url_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_pages(spark, sf_dir)).url_map.select("url", "doc_id")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_pages(spark, sf_dir)).lexicon.select("word", "word_id")


def url_map_lines_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_sinks.url_map_lines(url_map(spark, sf_dir)).orderBy("doc_id").select("line")


def url_map_lines_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_sinks.url_map_lines(url_map(spark, sf_dir)).orderBy("url").select("line")


def lexicon_lines_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_sinks.lexicon_lines_by_id(lexicon(spark, sf_dir)).orderBy("word_id").select("line")


def lexicon_lines_by_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_sinks.lexicon_lines_by_word(lexicon(spark, sf_dir)).orderBy("word").select("line")


def _consecutive_parts(pages: DataFrame, parts: int = 3) -> list[DataFrame]:
    """The pages cut into parts of consecutive files, which together hold all of them."""
    last = pages.agg(F.max("file_no")).first()[0] or 0
    files = last // parts + 1
    return [pages.where(F.col("file_no").between(i * files, (i + 1) * files - 1)) for i in range(parts)]


def _empty_state(spark: SparkSession) -> str:
    root = new_folder(spark, "state")
    index_stream.create(spark, root, DICTIONARY_BUCKETS)
    return root


def incremental_url_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _empty_state(spark)
    for batch, part in enumerate(_consecutive_parts(_site_pages(spark, sf_dir))):
        index_stream.extend_url_map(part, batch, root)
    return index_stream.read_state(spark, root, "url_map")


def incremental_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _empty_state(spark)
    for batch, part in enumerate(_consecutive_parts(_pages(spark, sf_dir))):
        words = tokens.page_tokens(part)
        index_stream.extend_lexicon(stage(words, "page_tokens").table, batch, root)
    return index_stream.read_state(spark, root, "lexicon")


def bucketed_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten batches, each asking the filters of those before which buckets it has to read."""
    root = _empty_state(spark)
    for batch, part in enumerate(_consecutive_parts(_pages(spark, sf_dir), STREAM_BATCHES)):
        words = tokens.page_tokens(part)
        index_stream.extend_lexicon(stage(words, "page_tokens").table, batch, root)
    return index_stream.read_state(spark, root, "lexicon")


# --- postings ---------------------------------------------------------------------------------------


def posting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_pages(spark, sf_dir)).postings


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_document_pages(spark, sf_dir)).postings


def partial_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_pages(spark, sf_dir)).partial_postings


def revisit_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_site_pages(spark, sf_dir)).revisit_postings()


def revisit_partial_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_site_pages(spark, sf_dir)).revisit_postings(by_file=True)


def document_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Index(_document_pages(spark, sf_dir)).revisit_postings()


def unindexed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Index(_mixed_pages(spark, sf_dir))
    side_by_side(spark, lambda: index.url_map, lambda: index.page_tokens)
    return postings.unindexed_docs(index.url_map, index.tokens)


def archive_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From gzip archives, pages of status 404 among them, to postings; URLs come from the index files."""
    pairs = _pairs(spark, _mixed_pages(spark, sf_dir))
    return Index(from_pairs(crawl.read_pairs(pairs)), urls_of_pairs(crawl.read_page_index(pairs))).postings


def postings_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joins with the dictionaries by shuffle, common words dealt out."""
    index = Index(_pages(spark, sf_dir))
    found = tokens.doc_tokens(index.page_tokens, index.url_map, small_bytes=0)
    return postings.postings(found, index.lexicon, small_bytes=0)


def posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry_text = F.transform("postings", lambda p: F.concat_ws(":", p["doc_id"].cast("string"), p["tf"].cast("string")))
    return postings.posting_lists(posting_rows(spark, sf_dir)).select(
        "word_id", "shard", "df", F.array_join(entry_text, " ").alias("list_text")
    )


def global_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.global_index_lines(posting_rows(spark, sf_dir))


def partial_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.partial_index_lines(partial_postings(spark, sf_dir))


def sharded_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, lines and byte codes in small shards, as the writers leave them; lines as they are read back."""
    path = new_folder(spark, "sharded")
    found = stage(posting_rows(spark, sf_dir), "postings").table
    tables.write_lists(postings.posting_bytes(found, SMALL_SHARD), f"{path}/bytes")
    text_sinks.write_lists(postings.global_index_lines(found, SMALL_SHARD), f"{path}/lines")
    codes = spark.read.parquet(f"{path}/bytes").select("word_id", "shard", "df", F.hex("bytes").alias("hex"))
    lines = spark.read.text(f"{path}/lines").select(
        F.split_part("value", F.lit(" "), F.lit(1)).cast("long").alias("word_id"), F.col("shard").cast("long").alias("shard"), F.col("value").alias("line")
    )
    return codes.join(lines, ["word_id", "shard"])


def partial_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the partial indexes as they are read back from their folders."""
    path = new_folder(spark, "partial_text")
    text_sinks.write_lists_by_file(partial_index_lines(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("file_no").cast("long").alias("file_no"), F.col("value").alias("line"))


def posting_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.posting_bytes(posting_rows(spark, sf_dir)).select(
        "word_id",
        "shard",
        "df",
        F.hex("bytes").alias("hex"),
        F.octet_length("bytes").cast("long").alias("n_bytes"),
    )


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Index(_pages(spark, sf_dir))
    return postings.index_stats(index.url_map, index.postings)


def word_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.word_stats(posting_rows(spark, sf_dir))


# --- runs -------------------------------------------------------------------------------------------


def _stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per input file, written and read back; sites come back, so runs share (word, document) pairs."""
    path = new_folder(spark, "runs")
    tables.write_runs(Index(_site_pages(spark, sf_dir)).partial_postings, path)
    return run_sources.read_runs(spark, path)


def merged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sets of runs, each in a folder of its own."""
    sets = []
    found = stage(Index(_site_pages(spark, sf_dir)).partial_postings, "partials").table
    for i in range(3):
        path = new_folder(spark, f"runs_{i}")
        tables.write_runs(found.where(F.col("file_no") % 3 == i), path)
        sets.append(run_sources.read_runs(spark, path).drop("file_no"))
    return runs.merge_runs(*sets)


def _compacted(spark: SparkSession, found: DataFrame, degree: int) -> tuple[DataFrame, DataFrame]:
    """The merged runs as they are read back, and the list of their files."""
    path = new_folder(spark, "compacted")
    files = tables.write_compacted(found, degree, path)
    return run_sources.read_runs(spark, path), files


def compacted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _compacted(spark, _stored_runs(spark, sf_dir), COMPACTION_DEGREE)
    return found.withColumnRenamed("file_no", "run_group")


def _runs_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_runs(spark, sf_dir).withColumn("file_no", F.col("file_no") * (F.col("file_no") + 3))


def compacted_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output of one pass is the input of the next."""
    first, _ = _compacted(spark, _runs_with_gaps(spark, sf_dir), COMPACTION_DEGREE)
    second, _ = _compacted(spark, first, 2)
    return second.withColumnRenamed("file_no", "run_group")


def compacted_run_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_group, n_rows) of the files that the list names."""
    _, files = _compacted(spark, _runs_with_gaps(spark, sf_dir), COMPACTION_DEGREE)
    named = [row["file"] for row in files.collect()]  # one name per merged run and task that wrote it
    rows = spark.read.parquet(*named).select(F.col("_metadata.file_path").alias("file"))
    sizes = rows.groupBy(F.regexp_extract("file", "file_no=([0-9]+)/", 1).cast("long").alias("run_group"))
    return sizes.agg(F.count("*").alias("n_rows"))


def rolled_up_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.roll_up(_stored_runs(spark, sf_dir))


def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose sites come back, landed in document order; the stream runs to its end after each landing."""
    landing, root = new_folder(spark, "landing"), new_folder(spark, "state")
    pages = _site_pages(spark, sf_dir)
    for part in _consecutive_parts(pages):
        part.write.mode("append").parquet(landing)
        index_stream.index_stream(spark.readStream.schema(pages.schema).parquet(landing), root).awaitTermination()
    return index_stream.global_postings(spark, root)


def archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive pairs that land out of order: the second third waits for the first, the last comes on its own."""
    landing, root = new_folder(spark, "crawl"), new_folder(spark, "state")
    first, second, third = _consecutive_parts(_mixed_pages(spark, sf_dir))
    for part in (second, first, third):
        _write_pairs(part, landing)
        pairs = pair_stream.stream_pairs(spark, landing, number=_PAIR_NUMBER, kind=_PAIR_KIND)
        index_stream.index_stream(from_pairs(pairs), root).awaitTermination()
    return index_stream.global_postings(spark, root)


def snapshot_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch, word_id, doc_id, tf): the postings as each committed batch left them, read when all had been added."""
    root = _empty_state(spark)
    versions = []
    for batch, part in enumerate(_consecutive_parts(_site_pages(spark, sf_dir))):
        index_stream.add_batch(part, batch, root, degree=2)
        versions.append(index_stream.last_version(spark, root))
    found = [index_stream.global_postings(spark, root, v).withColumn("batch", F.lit(i).cast("long")) for i, v in enumerate(versions)]
    return reduce(DataFrame.unionByName, found).select("batch", "word_id", "doc_id", "tf")


def incremental_word_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept up batch by batch, of sites that come back in later batches."""
    root = _empty_state(spark)
    for batch, part in enumerate(_consecutive_parts(_site_pages(spark, sf_dir))):
        index_stream.add_batch(part, batch, root)
    return index_stream.word_stats(spark, root)


def tiered_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty runs, merged by tiers as they come; the index is read from the few that are left."""
    root = _empty_state(spark)
    found = stage(Index(_site_pages(spark, sf_dir)).partial_postings, "partials").table
    for batch in range(TIERED_BATCHES):
        index_stream.add_run(found.where(F.col("file_no") % TIERED_BATCHES == batch).drop("file_no"), batch, root, COMPACTION_DEGREE)
    return index_stream.global_postings(spark, root)


def listed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs written as files of binary triples, read by the list of their names, merged."""
    path = new_folder(spark, "triples")
    found = runs.by_posting(Index(_site_pages(spark, sf_dir)).partial_postings, "file_no")
    files = stage(run_list.write_triples(found, f"{path}/files"), "triple_files").table
    run_list.write_list(files, f"{path}/list")
    return runs.merge_runs(run_list.read_listed(spark, f"{path}/list", split="1000"))


def entry(spark: SparkSession) -> DataFrame:
    """The global index, one line per word, of the smallest table set."""
    return _with_folder(global_index_lines)(spark, "/root/testdata/sf0.001")


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        page_status, odd_status, page_slices, pair_scan, refused_pages, archive_account, url_tokens, body_tokens, tag_events, token_contexts, varied_contexts, long_page_contexts,
        url_map, lexicon, url_map_lines_by_id, url_map_lines_by_url, lexicon_lines_by_id, lexicon_lines_by_word,
        incremental_url_map, incremental_lexicon, bucketed_lexicon,
        document_postings, partial_postings, revisit_postings, revisit_partial_postings, document_revisits,
        unindexed_docs, archive_postings, postings_shuffled, posting_lists, global_index_lines, sharded_lists,
        partial_index_lines, partial_index_text, posting_bytes, index_stats, word_stats,
        merged_runs, compacted_runs, compacted_twice, compacted_run_list, rolled_up_runs, listed_runs, tiered_runs,
        stream_index, archive_stream, snapshot_postings, incremental_word_stats,
    ]
    return {"postings": posting_rows} | {query.__name__: query for query in named}


def _llm_parts() -> list:
    """The modules with further queries, as far as they are there; errors inside them are not hidden."""
    names = ["wordloom.llm.queries", "corpus_pipeline"]
    there = all(importlib.util.find_spec(name) for name in ("wordloom.llm", "corpus_pipeline"))
    return [importlib.import_module(name) for name in names] if there else []


def _with_folder(query: Callable) -> Callable:
    """Sets a folder for stored stages where the session names none: a temporary one, in local mode only."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local") and not context.master.startswith("local-cluster"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-"))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = core_queries()
    for part in _llm_parts():
        found |= part.QUERIES
    return {name: _with_folder(query) for name, query in found.items()}


# --- the same results in SQL ------------------------------------------------------------------------

_SCRIPTS = r"(?is)<script(?:\s[^<>]*)?>(?:.*?</script(?:\s[^<>]*)?>|.*$)"
_TAGS = r"(?s)<[^>]*(?:>|$)"
_SITE = "regexp_replace(url, '/[0-9]+.*', '')"
_ALL = "SELECT page_id AS seq, page_id // 32 AS file_no, url, html AS body FROM pages"
_OK = f"{_ALL} WHERE NOT contains(url, '#')"
_SITES = f"SELECT page_id AS seq, page_id // 32 AS file_no, {_SITE} AS url, html AS body FROM pages"
_DOCUMENTS = "SELECT doc_id AS seq, doc_id // 32 AS file_no, source || '/' || lang AS url, text AS body FROM documents"


def _words(expression: str) -> str:
    return f"list_transform(regexp_extract_all({expression}, '[A-Za-z0-9]+'), lambda x: lower(x))"


_BODY_WORDS = _words(f"regexp_replace(regexp_replace(body, '{_SCRIPTS}', '<>', 'g'), '{_TAGS}', ' ', 'g')")


def _index(pages: str = _ALL, known: str | None = None) -> str:
    """Common table expressions: pages, token, url_map, lexicon, tf (per page)."""
    return f"""
WITH pg AS ({pages}),
arrays AS (SELECT seq, file_no, url, list_concat({_words('url')}, {_BODY_WORDS}) AS words FROM pg),
token AS (SELECT seq, file_no, url, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM arrays),
url_ids AS (
  SELECT url, row_number() OVER (ORDER BY min(seq)) - 1 AS doc_id FROM ({known or pages}) GROUP BY url
),
word_ids AS (
  SELECT word, row_number() OVER (ORDER BY seq, pos) - 1 AS word_id
  FROM (SELECT * FROM token QUALIFY row_number() OVER (PARTITION BY word ORDER BY seq, pos) = 1)
),
tf AS (
  SELECT seq, file_no, word_id, doc_id, count(*) AS n
  FROM token JOIN url_ids USING (url) JOIN word_ids USING (word) GROUP BY ALL
),
posting AS (SELECT word_id, doc_id, CAST(sum(n) AS BIGINT) AS tf FROM tf GROUP BY ALL),
run AS (SELECT file_no, word_id, doc_id, CAST(sum(n) AS BIGINT) AS tf FROM tf GROUP BY ALL)
"""


def _revisits(pages: str, keys: str) -> str:
    return _index(pages) + f"""
, walked AS (
  SELECT *, CASE WHEN lag(doc_id) OVER w = doc_id THEN 0 ELSE 1 END AS starts
  FROM tf WINDOW w AS (PARTITION BY {keys} ORDER BY seq)
),
numbered AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY {keys} ORDER BY seq) - 1 AS BIGINT) AS ordinal FROM walked
)
SELECT {keys}, ordinal, doc_id, CAST(sum(n) AS BIGINT) AS tf FROM numbered GROUP BY ALL"""


_FOUND_SQL = """,
found AS (
  SELECT page_id, doc, TRY_CAST(regexp_extract(doc, '^[^ ]* \\s*([+-]?[0-9]+)', 1) AS INTEGER) AS status,
    strpos(doc, chr(13) || chr(10) || chr(13) || chr(10)) AS head_end
  FROM response
)
SELECT page_id, status,
  lower(doc[1:5]) = 'http/' AND coalesce(status, 0) = 200 AND head_end > 0 AS is_ok,
  CASE WHEN head_end > 0 THEN length(doc) - head_end - 3 END AS body_len
FROM found"""

_STATUS_SQL = """
WITH response AS (
  SELECT page_id, 'HTTP/1.1 ' || CASE WHEN contains(url, '#') THEN '404 Not Found' ELSE '200 OK' END
    || chr(13) || chr(10) || 'Server: x' || chr(13) || chr(10) || chr(13) || chr(10) || html AS doc
  FROM pages
)""" + _FOUND_SQL

# A response ends at its NUL.
_ODD_SQL = """
WITH part AS (
  SELECT page_id, html, chr(13) || chr(10) || chr(13) || chr(10) AS e, translate(html, chr(13) || chr(10), '  ') AS flat FROM pages
),
response AS (
  SELECT page_id, CASE page_id % 7
    WHEN 0 THEN 'HTTP/1.1 200 OK' || e || html[1:40]
    WHEN 1 THEN 'HTTP/1.1 200 OK'
    WHEN 2 THEN 'ICY 200 OK' || e || html
    WHEN 3 THEN 'HTTP/1.1 200 OK' || chr(13) || chr(10) || flat
    WHEN 4 THEN 'http/1.0   200' || e || html
    WHEN 5 THEN 'HTTP/1.1 200 OK' || chr(10) || chr(10) || flat
    ELSE 'HTTP/1.1 none' || e || html END AS doc
  FROM part
)""" + _FOUND_SQL

_SEGMENTS = r"""
WITH parts AS (
  SELECT page_id, unnest(list) AS part, generate_subscripts(list, 1) - 1 AS seg, len(list) AS n
  FROM (SELECT page_id, string_split(html, '>') AS list FROM pages)
),
tagged AS (
  SELECT page_id, seg, split_part(part, '<', 1) AS txt,
    CASE WHEN seg < n - 1 AND contains(part, '<') THEN regexp_extract(part, '(?s)<([^<]*)$', 1) || ' ' END AS tag
  FROM parts
),
kinds AS (
  SELECT page_id, seg, txt, tag,
    CASE WHEN regexp_matches(tag, '(?i)^/?(b|strong)\s') THEN 'B'
         WHEN regexp_matches(tag, '(?i)^/?(i|em)\s') THEN 'I'
         WHEN regexp_matches(tag, '(?i)^/?h[1-6]\s') THEN 'H'
         WHEN regexp_matches(tag, '(?i)^/?title\s') THEN 'T'
         WHEN regexp_matches(tag, '(?i)^/?script\s') THEN 'S' END AS kind
  FROM tagged
),
switched AS (
  SELECT *, CASE WHEN kind IS NOT NULL THEN NOT starts_with(tag, '/') END AS is_open FROM kinds
)
"""


def _state(kind: str) -> str:
    return (
        f"coalesce(last_value(CASE WHEN kind = '{kind}' THEN is_open END IGNORE NULLS) "
        f"OVER (PARTITION BY page_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_{kind}"
    )


_CONTEXTS_SQL = _SEGMENTS + f"""
, stated AS (SELECT page_id, txt, {', '.join(_state(k) for k in 'BHITS')} FROM switched),
letters AS (
  SELECT page_id, unnest({_words('txt')}) AS word,
    CASE WHEN is_B THEN 'B' ELSE '' END || CASE WHEN is_H THEN 'H' ELSE '' END
    || CASE WHEN is_I THEN 'I' ELSE '' END || CASE WHEN is_T THEN 'T' ELSE '' END AS found
  FROM stated WHERE NOT is_S
),
both_parts AS (
  SELECT page_id, word, CASE WHEN found = '' THEN 'P' ELSE found END AS ctx FROM letters
  UNION ALL SELECT page_id, unnest({_words('url')}), 'U' FROM pages
)
SELECT page_id, word, ctx, count(*) AS n FROM both_parts GROUP BY ALL"""


def _varied() -> str:
    arms = [
        f"WHEN {i} THEN replace(replace(html, '<{old}>', '<{new}>'), '</{old}>', '</{new}>')" for i, (old, new) in enumerate(VARIED_TAGS)
    ]
    varied = f"WITH varied AS (SELECT page_id, url, CASE page_id % {len(VARIED_TAGS)} {' '.join(arms)} END AS html FROM pages),"
    return varied + _CONTEXTS_SQL.replace("FROM pages", "FROM varied").replace("WITH", "", 1)


def _refused_sql() -> str:
    return f"""SELECT file_no, line_no, '{crawl.CUT_SHORT}' AS reason FROM (
          SELECT page_id // 32 AS file_no, max(page_id % 32) AS line_no FROM pages GROUP BY 1) WHERE file_no % 4 = 1
        UNION ALL SELECT page_id // 32, page_id % 32, CASE WHEN page_id % 32 = 2 THEN '{crawl.FEW_COLUMNS}' ELSE '{crawl.NO_PLACE}' END
          FROM pages WHERE page_id // 32 % 4 = 2 AND page_id % 32 >= 2
        UNION ALL SELECT file_no, line_no, '{crawl.MORE_DATA}' FROM (
          SELECT page_id // 32 AS file_no, max(page_id % 32) + 1 AS line_no FROM pages GROUP BY 1) WHERE file_no % 4 = 3"""


def _end_to_end() -> str:
    long_pages = f"""WITH long_page AS (SELECT page_id // {PAGES_END_TO_END} AS page_id, arg_min(url, page_id) AS url,
        string_agg(html, '' ORDER BY page_id) AS html FROM pages GROUP BY page_id // {PAGES_END_TO_END}),"""
    return long_pages + _CONTEXTS_SQL.replace("FROM pages", "FROM long_page").replace("WITH", "", 1)


def _batches(parts: int) -> str:
    """Number of the batch of each page, as the files are cut into consecutive parts."""
    return f"file_no // (max(file_no) OVER () // {parts} + 1)"


def _vbyte(n: str) -> str:
    arms = []
    for i in range(5):
        group = f"(({n} >> {7 * i}) & 127)"
        flag = f"CASE WHEN {n} >= {1 << 7 * (i + 1)} THEN 128 ELSE 0 END"
        arms.append(f"CASE WHEN {i} = 0 OR {n} >= {1 << 7 * i} THEN lpad(hex({group} + {flag}), 2, '0') ELSE '' END")
    return "(" + " || ".join(arms) + ")"


def _lines(head: str, piece: str, keys: str, source: str) -> str:
    return f"""SELECT * EXCLUDE (list), {head} || list AS line FROM (
  SELECT {keys}, doc_id // {postings.SHARD_DOCS} AS shard, string_agg({piece}, '' ORDER BY doc_id) AS list
  FROM {source} GROUP BY ALL)"""


def core_oracle_sql() -> dict[str, str]:
    shard = f"doc_id // {postings.SHARD_DOCS} AS shard"
    site_index = _index(_SITES)
    return {
        "page_status": _STATUS_SQL,
        "odd_status": _ODD_SQL,
        "page_slices": """SELECT page_id // 32 AS file_no, page_id, strlen(html) AS length, CAST(coalesce(sum(strlen(html))
            OVER (PARTITION BY page_id // 32 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS BIGINT) AS start_at FROM pages""",
        "pair_scan": r"""WITH doc AS (SELECT page_id // 32 AS file_no, page_id, url, 'HTTP/1.1 200 OK' || chr(13) || chr(10)
            || 'Server: x' || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(10) AS d FROM pages)
            SELECT file_no, row_number() OVER f - 1 AS line_no, url, CAST(coalesce(sum(strlen(d)) OVER
            (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_at, strlen(d) AS length,
            md5(d) AS doc_md5 FROM doc WINDOW f AS (PARTITION BY file_no ORDER BY page_id)""",
        "refused_pages": _refused_sql(),
        "archive_account": f"""WITH refused AS ({_refused_sql()}), listed AS (SELECT page_id // 32 AS file_no, page_id % 32 AS line_no FROM pages)
            SELECT file_no, count(*) AS rows, count(*) FILTER (reason IS NULL) AS good, count(reason) AS refused
            FROM listed FULL JOIN refused USING (file_no, line_no) GROUP BY file_no""",
        "url_tokens": f"""SELECT page_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
            FROM (SELECT page_id, {_words('url')} AS w FROM pages)""",
        "body_tokens": f"""SELECT page_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
            FROM (SELECT page_id, {_BODY_WORDS} AS w FROM (SELECT page_id, html AS body FROM pages))""",
        "tag_events": _SEGMENTS
        + """SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY seg) AS seg, kind, is_open
            FROM switched WHERE kind IS NOT NULL""",
        "token_contexts": _CONTEXTS_SQL,
        "varied_contexts": _varied(),
        "long_page_contexts": _end_to_end(),
        "url_map": _index() + "SELECT url, doc_id FROM url_ids",
        "lexicon": _index() + "SELECT word, word_id FROM word_ids",
        "url_map_lines_by_id": _index() + "SELECT doc_id || ' ' || url AS line FROM url_ids ORDER BY doc_id",
        "url_map_lines_by_url": _index() + "SELECT doc_id || ' ' || url AS line FROM url_ids ORDER BY url",
        "lexicon_lines_by_id": _index() + "SELECT word_id || ' ' || word AS line FROM word_ids ORDER BY word_id",
        "lexicon_lines_by_word": _index() + "SELECT word || ' ' || word_id AS line FROM word_ids ORDER BY word",
        "incremental_url_map": site_index + "SELECT url, doc_id FROM url_ids",
        "incremental_lexicon": _index() + "SELECT word, word_id FROM word_ids",
        "bucketed_lexicon": _index() + "SELECT word, word_id FROM word_ids",
        "postings": _index() + "SELECT * FROM posting",
        "document_postings": _index(_DOCUMENTS) + "SELECT * FROM posting",
        "partial_postings": _index() + "SELECT * FROM run",
        "revisit_postings": _revisits(_SITES, "word_id"),
        "revisit_partial_postings": _revisits(_SITES, "file_no, word_id"),
        "document_revisits": _revisits(_DOCUMENTS, "word_id"),
        "unindexed_docs": _index(_OK, known=_ALL) + "SELECT doc_id, url FROM url_ids ANTI JOIN posting USING (doc_id)",
        "posting_lists": _index() + f"""SELECT word_id, {shard}, count(*) AS df,
            string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS list_text FROM posting GROUP BY ALL""",
        "global_index_lines": _index() + _lines("word_id || ' : '", "' ' || doc_id || ' ' || tf", "word_id", "posting"),
        "partial_index_lines": _index()
        + _lines("word_id || ' : '", "'< ' || doc_id || ' ' || tf || ' > '", "file_no, word_id", "run"),
        "posting_bytes": _index() + f"""SELECT *, strlen(hex) // 2 AS n_bytes FROM (SELECT word_id, {shard}, count(*) AS df,
            string_agg({_vbyte('doc_id')} || {_vbyte('tf')}, '' ORDER BY doc_id) AS hex FROM posting GROUP BY ALL)""",
        "index_stats": _index() + f"""SELECT count(DISTINCT word_id) AS n_words, (SELECT count(*) FROM url_ids) AS n_urls,
            count(*) AS n_postings, CAST(sum(strlen({_vbyte('doc_id')} || {_vbyte('tf')}) // 2)
            + 5 * count(DISTINCT word_id) AS BIGINT) AS n_bytes FROM posting""",
        "word_stats": _index() + """SELECT word_id, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf_sum,
            max(doc_id) AS max_doc_id FROM posting GROUP BY ALL""",
        "merged_runs": site_index + "SELECT word_id, doc_id, tf FROM run ORDER BY word_id, doc_id",
        "compacted_runs": site_index + f"SELECT file_no // {COMPACTION_DEGREE} AS run_group, word_id, doc_id, tf FROM run",
        "rolled_up_runs": site_index + "SELECT * FROM posting",
        "stream_index": site_index + "SELECT * FROM posting",
        "archive_stream": _index(_OK, known=_ALL) + "SELECT * FROM posting",
        "snapshot_postings": site_index + f""", batched AS (SELECT *, {_batches(3)} AS batch FROM tf)
            SELECT s.batch, word_id, doc_id, CAST(sum(n) AS BIGINT) AS tf
            FROM batched JOIN (SELECT unnest(range(3)) AS batch) AS s ON batched.batch <= s.batch GROUP BY ALL""",
        "incremental_word_stats": site_index + """SELECT word_id, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf_sum,
            max(doc_id) AS max_doc_id FROM posting GROUP BY ALL""",
        "tiered_runs": site_index + "SELECT * FROM posting",
        "listed_runs": site_index + "SELECT word_id, doc_id, tf FROM run ORDER BY word_id, doc_id",
        "archive_postings": _index(_OK, known=_ALL) + "SELECT * FROM posting",
        "postings_shuffled": _index() + "SELECT * FROM posting",
        "sharded_lists": _index() + f"""SELECT word_id, shard, df, hex, word_id || ' : ' || list AS line FROM (
            SELECT word_id, doc_id // {SMALL_SHARD} AS shard, count(*) AS df,
            string_agg({_vbyte('doc_id')} || {_vbyte('tf')}, '' ORDER BY doc_id) AS hex,
            string_agg(' ' || doc_id || ' ' || tf, '' ORDER BY doc_id) AS list FROM posting GROUP BY ALL)""",
        "partial_index_text": _index()
        + f"""SELECT file_no, line FROM ({_lines("word_id || ' : '", "'< ' || doc_id || ' ' || tf || ' > '", "file_no, word_id", "run")})""",
        "compacted_twice": site_index + f"""SELECT (dense_rank() OVER (ORDER BY file_no) - 1) // {2 * COMPACTION_DEGREE} AS run_group,
            word_id, doc_id, tf FROM run""",
        "compacted_run_list": site_index + f"""SELECT (n - 1) // {COMPACTION_DEGREE} AS run_group, count(*) AS n_rows
            FROM (SELECT dense_rank() OVER (ORDER BY file_no) AS n FROM run) GROUP BY ALL""",
    }


def oracle_sql() -> dict[str, str]:
    found = core_oracle_sql()
    for part in _llm_parts():
        found |= part.ORACLES
    return found
