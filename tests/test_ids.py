import random

import pytest
from pyspark.sql import functions as F

from wordloom.operators import ids
from wordloom.operators.lookup import lookup


def _firsts(spark, rows):
    return spark.createDataFrame(rows, "word STRING, first_seq BIGINT, first_pos INT, n_pages BIGINT")


@pytest.mark.parametrize("span", [10, 5_000, 1 << 26, 1 << 45, (1 << 63) - 1])
def test_ids_are_dense_and_in_order(spark, span):
    rng = random.Random(span)
    places = sorted({(rng.randrange(span), rng.randrange(50)) for _ in range(3_000)})
    rows = [(f"w{i}", seq, pos, 1) for i, (seq, pos) in enumerate(places)]
    shuffled = rng.sample(rows, len(rows))
    numbered = ids.dense_ids(_firsts(spark, shuffled), "word_id", ["first_seq", "first_pos"]).collect()
    assert {row.word: row.word_id for row in numbered} == {f"w{i}": i for i in range(len(rows))}


def test_ids_of_nothing(spark):
    assert ids.dense_ids(_firsts(spark, []), "word_id", ["first_seq", "first_pos"]).count() == 0


def test_ids_go_on_after_the_known_ones(spark):
    known = spark.createDataFrame([("a", 0), ("b", 1)], "word STRING, word_id BIGINT")
    firsts = _firsts(spark, [("b", 3, 0, 1), ("d", 9, 1, 1), ("c", 9, 0, 1)])
    new = firsts.join(known, "word", "left_anti")
    numbered = ids.dense_ids(new, "word_id", ["first_seq", "first_pos"], 2).collect()
    assert {row.word: row.word_id for row in numbered} == {"c": 2, "d": 3}
    first = ids.dense_ids(firsts, "word_id", ["first_seq", "first_pos"], 0)
    assert first.agg(F.min("word_id")).first()[0] == 0


def test_lookup_is_the_same_however_it_joins(spark):
    rng = random.Random(5)
    words = ["the"] * 4_000 + [f"w{rng.randrange(300)}" for _ in range(6_000)] + ["x" * 300] * 500
    facts = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word STRING, doc_id BIGINT")
    entries = [(w, i, words.count(w)) for i, w in enumerate(sorted(set(words)))]
    dictionary = spark.createDataFrame(entries, "word STRING, word_id BIGINT, n_pages BIGINT")

    def found(**options):
        joined = lookup(facts, dictionary, "word", "word_id", "n_pages", "doc_id", **options)
        return sorted((r.word, r.doc_id, r.word_id) for r in joined.collect())

    small = found()
    assert len(small) == len(words)
    assert found(small_bytes=0) == small


def test_hot_keys_do_not_meet_in_one_partition(spark):
    facts = spark.range(40_000).select(F.lit("the").alias("word"), F.col("id").alias("doc_id"))
    dictionary = spark.createDataFrame([("the", 0, 40_000), ("of", 1, 10)], "word STRING, word_id BIGINT, n_pages BIGINT")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(facts, dictionary, "word", "word_id", "n_pages", "doc_id", small_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(sizes) == 40_000 and max(sizes) < 15_000


def test_many_hot_keys_are_spread_evenly(spark):
    facts = spark.range(200_000).select(F.concat(F.lit("w"), (F.col("id") % 5).cast("string")).alias("word"), F.col("id").alias("doc_id"))
    dictionary = facts.groupBy("word").agg(F.count("*").alias("n_pages"), F.max("doc_id").alias("word_id"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for key, value in zip(before, ("false", "-1", "32")):
        spark.conf.set(key, value)
    try:
        joined = lookup(facts, dictionary, "word", "word_id", "n_pages", "doc_id", small_bytes=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 200_000 and max(sizes) < 4 * 200_000 / 32


@pytest.mark.parametrize("small_bytes", [0, 1 << 20])
def test_a_missing_entry_is_an_error(spark, small_bytes):
    facts = spark.createDataFrame([("a", 1), ("b", 2)], "word STRING, doc_id BIGINT")
    dictionary = spark.createDataFrame([("a", 0, 1)], "word STRING, word_id BIGINT, n_pages BIGINT")
    with pytest.raises(Exception, match="no word_id for word b"):
        lookup(facts, dictionary, "word", "word_id", "n_pages", "doc_id", small_bytes=small_bytes).collect()
