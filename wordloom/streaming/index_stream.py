"""Micro-batches of pages extend the dictionaries and append runs of postings.

The state is a list of parts (``snapshots``): for each batch the new entries of both dictionaries by bucket
with their filters (``buckets``), and a run of postings; and the progress of the stream, which belongs to that
state alone. A batch reads the dictionaries' buckets that its keys may be in, writes all its tables to fresh
folders and commits them in one step, so a batch that ends early changes nothing, and a batch that is
committed is not added again. IDs follow the order of batches, and document order inside a batch.
"""

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wordloom.operators import dictionaries, postings, runs
from wordloom.operators.ids import dense_ids
from wordloom.operators.tokens import all_page_tokens, doc_tokens
from wordloom.plans.stages import Stage, passing_stages, side_by_side, stage, stage_dictionary, stage_firsts
from wordloom.schemas import FILTERS, LEXICON, POSTINGS, URL_MAP, WORD_STATS
from wordloom.streaming import buckets
from wordloom.streaming.snapshots import Part, Snapshot, Snapshots

logger = logging.getLogger(__name__)

_TABLES = {"url_map": URL_MAP, "lexicon": LEXICON, "runs": POSTINGS, "stats": WORD_STATS, "url_map_filters": FILTERS, "lexicon_filters": FILTERS}
#: Buckets of each dictionary, fixed when a state is made: enough that the new entries of one of a batch fit a task.
BUCKETS = 64
#: Runs of like size that are merged into one, see ``merge_tiers``.
DEGREE = 8


def create(spark: SparkSession, root: str, n_buckets: int = BUCKETS) -> None:
    """Empty state under ``root``, unless there is one."""
    state = Snapshots(spark, root)
    if not state.versions():
        state.commit(Snapshot(0, {"buckets": n_buckets}))


def read_state(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """Rows of a table in the last committed version, or in one of those before it that are kept."""
    return _read(spark, root, Snapshots(spark, root).read(version).of(name), _TABLES[name])


def _read(spark: SparkSession, root: str, parts: list[Part], schema: StructType) -> DataFrame:
    return _folders(spark, [f"{root}/{part.folder}" for part in parts if part.rows], schema)


def _folders(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths) if paths else spark.createDataFrame([], schema)


def extend_url_map(pages: DataFrame, batch: int, root: str) -> Stage:
    """Give new URLs of the batch their IDs; returns the entries of the batch's URLs."""
    return _committed(pages.sparkSession, root, *_extend(dictionaries.url_firsts(pages), root, "url_map", "url", "doc_id", dictionaries.URL_ORDER, batch))


def extend_lexicon(tokens: DataFrame, batch: int, root: str) -> Stage:
    """Give new words of the batch their IDs; returns the entries of the batch's words."""
    return _committed(tokens.sparkSession, root, *_extend(dictionaries.word_firsts(tokens), root, "lexicon", "word", "word_id", dictionaries.WORD_ORDER, batch))


def _committed(spark: SparkSession, root: str, found: Stage, parts: list[Part]) -> Stage:
    state = Snapshots(spark, root)
    state.commit(state.read().changed(parts))
    return found


def add_batch(pages: DataFrame, batch: int, root: str, degree: int = DEGREE) -> None:
    """Index one batch of pages (seq, file_no, url, doc); a batch that is committed already is left alone."""
    spark = pages.sparkSession
    state = Snapshots(spark, root)
    if batch <= state.read().last_batch("runs"):
        return
    with passing_stages(spark):
        # The pages are read once: a source such as an archive is dear to read.
        listed = stage(all_page_tokens(pages), "page_tokens").table
        tokens = listed.where("ok").drop("ok")
        (urls, url_parts), (words, word_parts) = side_by_side(
            spark,
            lambda: _extend(dictionaries.url_firsts(listed), root, "url_map", "url", "doc_id", dictionaries.URL_ORDER, batch),
            lambda: _extend(dictionaries.word_firsts(tokens), root, "lexicon", "word", "word_id", dictionaries.WORD_ORDER, batch),
        )
        tokens = doc_tokens(tokens, urls.table, **urls.measured)
        found = stage(postings.postings(tokens, words.table, **words.measured), "postings").table
        now = state.read()
        run = _write(runs.by_posting(found), root, "runs", batch)
        stats = _write(_new_stats(found, now, root), root, "stats", batch)
        state.commit(now.changed([*url_parts, *word_parts, run, stats]))
    merge_tiers(spark, root, degree)


def word_stats(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(word_id, df, tf_sum, max_doc_id) over all committed batches, from what each has added; no posting is read."""
    rows = read_state(spark, root, "stats", version)
    return rows.groupBy("word_id").agg(F.sum("df").alias("df"), F.sum("tf_sum").alias("tf_sum"), F.max("max_doc_id").alias("max_doc_id"))


def _new_stats(found: DataFrame, now: Snapshot, root: str) -> DataFrame:
    """What a batch's postings add to each word's statistics.

    A posting counts for df unless an earlier batch has one of its word and document. Only documents that return
    can have one; the runs are asked for these alone, and not read at all if the batch has none.
    """
    spark = found.sparkSession
    last = _read(spark, root, now.of("url_map_filters"), FILTERS).agg(F.max("max_id")).first()[0]
    returning = found.where(F.col("doc_id") <= F.lit(-1 if last is None else last))
    new = F.lit(1)
    if returning.limit(1).count():
        docs = returning.select("doc_id").distinct()
        known = _read(spark, root, now.of("runs"), POSTINGS).join(docs, "doc_id", "left_semi").select("word_id", "doc_id", F.lit(0).alias("_new")).distinct()
        found, new = found.join(known, ["word_id", "doc_id"], "left"), F.coalesce("_new", F.lit(1))
    return found.groupBy("word_id").agg(F.sum(new).alias("df"), F.sum("tf").alias("tf_sum"), F.max("doc_id").alias("max_doc_id"))


def add_run(found: DataFrame, batch: int, root: str, degree: int = DEGREE) -> None:
    """Append a run of postings (word_id, doc_id, tf) made elsewhere; a batch that is committed already is left alone."""
    state = Snapshots(found.sparkSession, root)
    now = state.read()
    if batch > now.last_batch("runs"):
        state.commit(now.changed([_write(runs.by_posting(found), root, "runs", batch)]))
        merge_tiers(found.sparkSession, root, degree)


def last_version(spark: SparkSession, root: str) -> int:
    return Snapshots(spark, root).read().version


def live_runs(spark: SparkSession, root: str) -> list[Part]:
    """The runs that the last version holds."""
    return Snapshots(spark, root).read().of("runs")


def tier(rows: int, degree: int) -> int:
    """Runs of one tier differ in size by less than the factor ``degree``."""
    found = 0
    while rows >= degree:
        rows //= degree
        found += 1
    return found


def merge_tiers(spark: SparkSession, root: str, degree: int = DEGREE) -> int:
    """Merge runs until no tier has ``degree`` of them; returns the number of merges.

    A merge adds up equal postings, writes one run and puts it in the place of the others in one step. So a
    posting is written again once per tier, and a state of n batches has some degree * log(n) runs.
    """
    state, merges = Snapshots(spark, root), 0
    while True:
        now = state.read()
        tiers: dict[int, list[Part]] = {}
        for part in now.of("runs"):
            tiers.setdefault(tier(part.rows, degree), []).append(part)
        full = [parts for _, parts in sorted(tiers.items()) if len(parts) >= degree]
        if not full:
            return merges
        old = full[0][:degree]
        merged = runs.by_posting(runs.roll_up(_read(spark, root, old, POSTINGS)))
        state.commit(now.changed([_write(merged, root, "runs", max(part.batch for part in old))], old))
        merges += 1


def global_postings(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(word_id, doc_id, tf) over all committed batches."""
    return runs.roll_up(read_state(spark, root, "runs", version))


def index_stream(pages: DataFrame, root: str, degree: int = DEGREE) -> StreamingQuery:
    """Index a stream of pages until its present input is used up.

    The progress is kept under ``root``: a stopped stream goes on where it was. A state whose batches were
    added in another way has none; it is refused, as a stream that starts anew numbers its batches from 0.
    """
    spark = pages.sparkSession
    create(spark, root)
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/progress")
    there = marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)
    if not there and live_runs(spark, root):
        raise ValueError(f"{root}: has batches, but no progress of a stream")
    return (
        pages.writeStream.foreachBatch(lambda batch, number: add_batch(batch, number, root, degree))
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


def _extend(
    firsts: DataFrame, root: str, name: str, key: str, id_column: str, order: list[str], batch: int
) -> tuple[Stage, list[Part]]:
    """Write the batch's new keys of a dictionary; returns the IDs of the batch's keys only, with page counts, and the parts to commit.

    Earlier entries are read from the buckets that may hold a key of the batch and
    while the batch's keys are few enough to broadcast, never shuffled. Which buckets these are comes to
    the driver, a row per bucket of a batch, as a list of folders to read.
    """
    spark = firsts.sparkSession
    now = Snapshots(spark, root).read()
    n_buckets, folders = now.settings["buckets"], {part.batch: part.folder for part in now.of(name)}
    stored = stage(firsts.withColumn("bucket", buckets.bucket_of(key, n_buckets)), f"{name}_firsts").table
    filters = _read(spark, root, now.of(f"{name}_filters"), FILTERS)
    asked = buckets.asked(stored.select("bucket", key), key, filters).collect()
    paths = [f"{root}/{folders[row['batch']]}/bucket={row['bucket']}" for row in asked]
    entries = _folders(spark, paths, _TABLES[name])
    keys = stored.drop("bucket")
    old = stage_dictionary(entries.join(keys, key), f"old_{name}", key)
    new = stage_firsts(keys.join(old.table.select(key), key, "left_anti"), f"new_{name}")
    last_seq = new.measured["last_seq"] or 0
    last_id = filters.agg(F.max("max_id")).first()[0]
    numbered = dense_ids(new.table, id_column, order, 0 if last_id is None else last_id + 1, last_seq)
    added = stage_dictionary(numbered, f"added_{name}", key)
    placed = added.table.select(key, id_column, buckets.bucket_of(key, n_buckets))
    parts = [
        _write(placed.repartition("bucket").sortWithinPartitions("bucket", id_column), root, name, batch, "bucket"),
        _write(buckets.filters(placed, key, id_column, batch), root, f"{name}_filters", batch),
    ]
    measured = {"dictionary_bytes": sum(part.measured["dictionary_bytes"] for part in (old, added))}
    logger.info("%s, batch %d: %d buckets with %d entries read", name, batch, len(asked), sum(row["n"] for row in asked))
    return Stage(old.table.unionByName(added.table), measured), parts


def _write(rows: DataFrame, root: str, name: str, batch: int, *by: str) -> Part:
    """Write a part of a table to a folder of its own; nobody reads it before it is committed."""
    folder, observed = Snapshots(rows.sparkSession, root).new_folder(name), Observation()
    rows.observe(observed, F.count("*").alias("n")).write.partitionBy(*by).parquet(f"{root}/{folder}")
    return Part(name, folder, batch, observed.get["n"])
