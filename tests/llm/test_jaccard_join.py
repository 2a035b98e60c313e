import random

import brute
import pytest
from wordloom.llm import jaccard_join
from wordloom.llm.components import components
from wordloom.llm.jaccard_join import Measure, near_duplicates


@pytest.mark.parametrize("k, percent, region", [(4, 85, 1 << 20), (5, 80, 1 << 20), (2, 50, 200), (1, 40, 60), (1, 20, 1 << 20), (4, 100, 1 << 20), (3, 85, 100)])
def test_equals_brute_force(messy, k, percent, region):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    expected = brute.components(rows, k, percent)
    found = near_duplicates(messy, Measure(k, percent), region_shingles=region).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((d, *expected[i])) for i, (d, _) in enumerate(rows))


def test_a_small_set_in_a_larger_one(spark):
    """7 of 16 words: sizes two powers of two apart."""
    words = [f"w{i}" for i in range(16)]
    docs = spark.createDataFrame([(1, " ".join(words[:7])), (2, " ".join(words)), (3, "other words")], "doc_id long, text string")
    found = near_duplicates(docs, Measure(1, 40)).collect()
    assert sorted(map(tuple, found)) == [(1, 7, 1, 1), (2, 16, 1, 1), (3, 2, 3, 0)]


@pytest.mark.parametrize("region", [1 << 20, 2000])
def test_links_of_a_dense_group(spark, region):
    """Near copies of one text and copies of those, in one region and in many blocks."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[3][1]) for i in range(20)]
    expected = brute.components(rows, 2, 80)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), Measure(2, 80), region_shingles=region).collect()
    assert sorted(map(tuple, found)) == sorted((d, *expected[i]) for i, (d, _) in enumerate(rows))


def test_texts_that_meet_by_chance_are_not_sent(spark, monkeypatch):
    """40 texts share a passage and nothing else; their texts went to its regions, the more of them the larger the input."""
    rng = random.Random(9)
    rows = [(i, " ".join(["of one passage here"] + [f"v{rng.randrange(10**6)}" for _ in range(60 + i % 9)])) for i in range(40)]
    rows += [(100, rows[7][1] + " more"), (101, "more " + rows[7][1])]
    expected = brute.components(rows, 2, 80)
    sent, texts = [], jaccard_join._with_texts

    def counted(rows, facts, members, measure):
        sent.append(members.select("node").distinct().count())
        return texts(rows, facts, members, measure)

    monkeypatch.setattr(jaccard_join, "_with_texts", counted)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), Measure(2, 80)).collect()
    assert sorted(map(tuple, found)) == sorted((d, *expected[i]) for i, (d, _) in enumerate(rows))
    assert sent == [3]


def test_empty_table(empty):
    assert near_duplicates(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (300, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {found[130]}
    assert {found[i] for i in [5, 300, *range(200, 260)]} == {found[5]} != {found[130]}
