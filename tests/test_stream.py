import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sequential
from test_index import _corpus, as_pages
from wordloom.plans.index_build import Index
from wordloom.plans.stages import stage
from wordloom.schemas import PAGES
from wordloom.streaming import buckets, index_stream
from wordloom.streaming.snapshots import KEPT_VERSIONS, Part, Snapshot, Snapshots


def _land(spark, corpus, landing, parts):
    """One file per part, each later than the one before: the file source goes by modification time."""
    pages = as_pages(spark, corpus)
    step = len(corpus) // parts + 1
    for i in range(parts):
        pages.where(f"seq >= {i * step} AND seq < {(i + 1) * step}").coalesce(1).write.mode("append").parquet(landing)
        time.sleep(0.05)


def _state(spark, root):
    return (
        {r.url: r.doc_id for r in index_stream.read_state(spark, root, "url_map").collect()},
        {r.word: r.word_id for r in index_stream.read_state(spark, root, "lexicon").collect()},
        {(r.word_id, r.doc_id): r.tf for r in index_stream.global_postings(spark, root).collect()},
    )


def test_batches_in_order_give_the_one_pass_result(spark, tmp_path):
    corpus = _corpus(120, seed=8)
    landing, root = (str(tmp_path / name) for name in ("landing", "state"))
    _land(spark, corpus, landing, 3)
    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", 1).parquet(landing)
    index_stream.index_stream(stream, root).awaitTermination()
    expected = sequential.build(corpus)[:3]
    assert _state(spark, root) == expected
    assert [part.batch for part in index_stream.live_runs(spark, root)] == [0, 1, 2]

    # a second start finds nothing new
    index_stream.index_stream(stream, root).awaitTermination()
    assert _state(spark, root) == expected


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    corpus = _corpus(90, seed=9)
    root = str(tmp_path / "state")
    pages = as_pages(spark, corpus)
    index_stream.create(spark, root)
    first, second = pages.where("seq < 40"), pages.where("seq >= 40")
    index_stream.add_batch(first, 0, root)
    index_stream.add_batch(second, 1, root)
    expected = sequential.build(corpus)[:3]
    assert _state(spark, root) == expected
    index_stream.add_batch(second, 1, root)
    assert _state(spark, root) == expected
    index_stream.create(spark, root)
    assert _state(spark, root) == expected


def test_batches_without_anything_new(spark, tmp_path):
    corpus = _corpus(30, seed=10)
    root = str(tmp_path / "state")
    pages = as_pages(spark, corpus)
    index_stream.create(spark, root)
    index_stream.add_batch(pages, 0, root)
    index_stream.add_batch(pages, 1, root)
    index_stream.add_batch(pages.where("seq < 0"), 2, root)
    urls, lexicon, counts = sequential.build(corpus)[:3]
    assert _state(spark, root) == (urls, lexicon, {key: 2 * tf for key, tf in counts.items()})
    stats = {r.word_id: (r.df, r.tf_sum, r.max_doc_id) for r in index_stream.word_stats(spark, root).collect()}
    expected = {}
    for (word, doc), tf in counts.items():
        df, total, last = expected.get(word, (0, 0, -1))
        expected[word] = (df + 1, total + 2 * tf, max(last, doc))
    assert stats == expected


def test_index_of_no_pages(spark):
    index = Index(as_pages(spark, _corpus(5)).where("seq < 0"))
    assert index.postings.count() == index.url_map.count() == index.lexicon.count() == 0
    assert index.revisit_postings().count() == 0


def test_a_state_without_progress_is_refused(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "state")
    corpus = _corpus(20, seed=11)
    index_stream.create(spark, root)
    index_stream.add_batch(as_pages(spark, corpus), 0, root)
    before = _state(spark, root)
    _land(spark, corpus, landing, 1)
    with pytest.raises(ValueError, match="no progress"):
        index_stream.index_stream(spark.readStream.schema(PAGES).parquet(landing), root)
    assert _state(spark, root) == before


def test_a_batch_leaves_no_stages(spark, tmp_path):
    root = str(tmp_path / "state")
    pages = stage(as_pages(spark, _corpus(20, seed=12)), "pages").table
    index_stream.create(spark, root)
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "wordloom"
    before = set(folder.iterdir())
    index_stream.add_batch(pages, 0, root)
    assert set(folder.iterdir()) == before


def test_a_batch_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    corpus = _corpus(60, seed=13)
    root = str(tmp_path / "state")
    pages = as_pages(spark, corpus)
    index_stream.create(spark, root)
    index_stream.add_batch(pages.where("seq < 30"), 0, root)
    before = _state(spark, root)
    write = index_stream._write

    def failing(rows, root, name, *more):
        if name == "runs":
            raise RuntimeError("lost")
        return write(rows, root, name, *more)

    monkeypatch.setattr(index_stream, "_write", failing)
    with pytest.raises(RuntimeError, match="lost"):
        index_stream.add_batch(pages.where("seq >= 30"), 1, root)
    monkeypatch.undo()
    assert _state(spark, root) == before
    assert len(Snapshots(spark, root).vacuum()) == 4  # two dictionaries with their filters
    index_stream.add_batch(pages.where("seq >= 30"), 1, root)
    assert _state(spark, root) == sequential.build(corpus)[:3]


def test_versions(spark, tmp_path):
    state = Snapshots(spark, str(tmp_path / "state"))
    assert state.read() == Snapshot() and state.vacuum() == []
    first = state.commit(Snapshot(0, {"a": 1}))
    part = Part("runs", "runs/x", 4, 10)
    second = state.commit(first.changed([part]))
    assert state.read() == second and state.read(0) == first
    assert second.last_batch("runs") == 4 and second.last_batch("lexicon") == -1
    assert second.changed([], [part]).parts == ()
    with pytest.raises(RuntimeError, match="another writer"):
        state.commit(first.changed([]))
    for _ in range(KEPT_VERSIONS + 3):
        second = state.commit(second.changed([]))
    assert len(state.versions()) == KEPT_VERSIONS and state.read() == second


def test_snapshots_stay_as_they_were(spark, tmp_path):
    corpus = _corpus(40, seed=14)
    root = str(tmp_path / "state")
    pages = as_pages(spark, corpus)
    index_stream.create(spark, root)
    index_stream.add_batch(pages.where("seq < 20"), 0, root)
    version = Snapshots(spark, root).read().version
    index_stream.add_batch(pages.where("seq >= 20"), 1, root, degree=2)
    counts = sequential.build(corpus[:20])[2]
    assert {(r.word_id, r.doc_id): r.tf for r in index_stream.global_postings(spark, root, version).collect()} == counts


def test_runs_are_merged_by_tiers(spark, tmp_path):
    corpus = _corpus(100, seed=15)
    root = str(tmp_path / "state")
    pages = as_pages(spark, corpus)
    index_stream.create(spark, root, n_buckets=4)
    for batch in range(20):
        index_stream.add_batch(pages.where(f"seq >= {batch * 5} AND seq < {batch * 5 + 5}"), batch, root, degree=3)
    live = index_stream.live_runs(spark, root)
    assert len(live) < 9
    tiers = [index_stream.tier(part.rows, 3) for part in live]
    assert max(map(tiers.count, tiers)) < 3
    assert _state(spark, root) == sequential.build(corpus)[:3]
    # a batch that went into a merged run is not added again
    index_stream.add_batch(pages.where("seq >= 95"), 19, root, degree=3)
    assert _state(spark, root) == sequential.build(corpus)[:3]


@pytest.mark.parametrize("rows, expected", [(0, 0), (2, 0), (3, 1), (8, 1), (9, 2), (26, 2), (27, 3)])
def test_tier(rows, expected):
    assert index_stream.tier(rows, 3) == expected


def test_filters(spark):
    held = spark.range(0, 3000).select(F.concat(F.lit("k"), "id").alias("word"), F.col("id").alias("word_id"))
    placed = held.withColumn("bucket", buckets.bucket_of("word", 7))
    known = stage(buckets.filters(placed, "word", "word_id", 5), "filters").table
    assert {r.batch for r in known.collect()} == {5}
    assert sum(r.n for r in known.collect()) == 3000 and max(r.max_id for r in known.collect()) == 2999

    def hits(first, last):
        keys = spark.range(first, last).select(F.concat(F.lit("k"), "id").alias("word"))
        keys = keys.withColumn("bucket", buckets.bucket_of("word", 7))
        met = keys.join(known.drop("batch", "n", "max_id"), "bucket").where(buckets.may_hold(F.col("bits"), F.col("word")))
        return met.count()

    assert hits(0, 3000) == 3000
    assert hits(3000, 23000) < 0.03 * 20000


def test_only_buckets_that_may_hold_a_key_are_read(spark, tmp_path, caplog):
    root = str(tmp_path / "state")
    index_stream.create(spark, root, n_buckets=16)

    def pages(first, last):
        rows = spark.range(first, last)
        return rows.select(F.col("id").alias("seq"), F.lit(0).cast("long").alias("file_no"), F.concat(F.lit("u"), "id").alias("url"), F.lit("").alias("doc"))

    caplog.set_level("INFO", logger="wordloom.streaming.index_stream")
    index_stream.extend_url_map(pages(0, 400), 0, root)
    index_stream.extend_url_map(pages(400, 404), 1, root)
    index_stream.extend_url_map(pages(400, 402), 2, root)
    read = [tuple(map(int, re.findall(r"(\d+) buckets with (\d+) entries", r.message)[0])) for r in caplog.records]
    assert read[0] == (0, 0) and read[1][0] <= 1 and 1 <= read[2][0] <= 3 and read[2][1] <= 60
    assert {r.url: r.doc_id for r in index_stream.read_state(spark, root, "url_map").collect()} == {f"u{i}": i for i in range(404)}
