import math
import random

import pytest
from pyspark.sql import functions as F
from wordloom.llm.topk import quantized, top_k

ROWS = [(i, [math.sin(i * j + 1) for j in range(9)]) for i in range(120)]
ROWS += [(200 + i, [0.5] * 9) for i in range(30)]  # equal vectors
ROWS += [(None, [9.0] * 9), (301, None), (302, [1.0, None]), (303, [float("nan")] * 9), (304, [float("inf")]), (350, []), (305, [3.0]), ROWS[7], ROWS[50]]


@pytest.mark.parametrize("blocks, lists", [((4096, 1024), 4), ((16, 2), 3), ((7, 1), 12)])
def test_equals_brute_force(spark, blocks, lists):
    table = spark.createDataFrame(ROWS, "vec_id long, embedding array<double>").repartition(4)
    vectors = table.select("vec_id", quantized("embedding").alias("vector"), F.lit(1).alias("block"))
    found = top_k(vectors, F.col("vec_id") % 50 == 0, 5, candidate_block=blocks[0], query_block=blocks[1], lists=lists).collect()
    usable = {i: [math.floor(256 * x) for x in v] for i, v in ROWS if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    expected = []
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable.items() if i != q)
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1]), (1, [2])], "vec_id long, vector array<long>")
    assert [tuple(r) for r in top_k(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2)]
    assert top_k(table.limit(0), F.col("vec_id") == 0).collect() == []


def test_large_components(spark):
    """Components of 2^41, and of 50,000 in 64 dimensions: scores that doubles cannot hold but 64 bits can."""
    rng = random.Random(7)
    rows = [(i, [float(rng.randint(-16, 16)), rng.uniform(-(2.0**22), 2.0**22), 1.0 / 256, float(i)]) for i in range(40)]
    rows += [(100 + i, [0.0] + [50_000.0 + i % 3] * 63) for i in range(8)]
    rows += [(200, [2.0**41, 0.0]), (201, [1.0 / 256, 3.0]), (202, [2.0**60]), (203, [float("inf")])]
    table = spark.createDataFrame(rows, "vec_id long, e array<double>").select("vec_id", quantized("e").alias("v"))
    whole = {r.vec_id: r.v for r in table.collect() if r.v is not None}
    assert set(whole) == {i for i, _ in rows} - {202, 203}
    found = top_k(table, F.col("vec_id") % 2 == 0, k=4, vector="v", candidate_block=16, query_block=8).collect()
    for q in whole:
        if q % 2 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:4]
            assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == [(i, -s) for s, i in scores]
