"""Columns of the input named like those that an operator makes or uses inside."""

import pytest
from pyspark.sql import functions as F
from wordloom.llm.line_dedup import dedup_lines
from wordloom.llm.mixing import mix, mixed_rows
from wordloom.llm.sharding import shards


@pytest.fixture(scope="module")
def clashing(spark):
    names = ["n_lines", "n_dropped", "_doc", "_key", "_drops", "_rest", "_rank", "_cut", "_whole", "size", "copies", "shard", "slot", "_range", "_row", "_by0"]
    rows = [(i, f"some line of text\nown line number {i}\nsome line of text", "s", *range(len(names))) for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))


def plain(table):
    return table.select("doc_id", "text", "source")


def test_line_dedup(clashing):
    found, expected = dedup_lines(clashing), dedup_lines(plain(clashing))
    assert sorted(found.columns) == sorted(clashing.columns)
    assert sorted(map(tuple, found.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert {(r._doc, r._drops, r._rest) for r in found.collect()} == {(2, 4, 5)}


def test_mixing(clashing):
    found, expected = mix(clashing), mix(plain(clashing))
    assert sorted(map(tuple, found.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert {(r._rest, r._rank, r._cut) for r in found.collect()} == {(5, 6, 7)}
    rows = mixed_rows(clashing)
    assert rows.columns == clashing.columns and {(r.size, r.copies) for r in rows.collect()} == {(9, 10)}


def test_sharding(clashing):
    found = shards(clashing, ["doc_id"], 4, ["doc_id"], ["doc_id", "shard", "slot", "_range", "_row", "_by0"])
    expected = shards(plain(clashing), ["doc_id"], 4, ["doc_id"], ["doc_id"])
    assert sorted(found.columns) == sorted(["doc_id", "_range", "_row", "_by0", "shard", "grown_shard", "slot"])
    assert sorted(map(tuple, found.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert found.select(F.col("_range"), F.col("_row"), F.col("_by0")).distinct().collect() == [(13, 14, 15)]
