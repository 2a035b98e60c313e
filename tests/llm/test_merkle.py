import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from wordloom.llm.merkle import address, build, height_of, laid_out, leaf_digest, nodes_in, proofs, runs_of, siblings


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """All levels of digests over the leaves, each run of 16 under one node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, pos):
    """What stands left and right at each level."""
    found = []
    for level in levels[:-1]:
        start = pos - pos % 16
        run = level[start : start + 16]
        found.append(("".join(run[: pos - start]), "".join(run[pos - start + 1 :])))
        pos //= 16
    return found


def manifest(rows):
    """{row number: (leaf, subroot, root, proof, folded, verified)} of [(source, doc_id, leaf, claimed)]."""
    none_first = lambda x: (x is not None, x if x is not None else "")
    sources = sorted({r[0] for r in rows}, key=lambda s: none_first(None if s is None else s.encode()))
    trees = {}
    for source in sources:
        members = sorted((i for i, r in enumerate(rows) if r[0] == source), key=lambda i: ((rows[i][1] is not None, rows[i][1] or 0), rows[i][2]))
        trees[source] = (members, tree([rows[i][2] for i in members]))
    top = tree([trees[s][1][-1][0] for s in sources])
    found = {}
    for n, source in enumerate(sources):
        members, levels = trees[source]
        for pos, i in enumerate(members):
            steps = path(levels, pos) + path(top, n)
            folded = rows[i][3] or rows[i][2]
            for a, b in steps:
                folded = h(a, folded, b)
            found[i] = (rows[i][2], levels[-1][0], top[-1][0], h(*[a + b for a, b in steps]), folded, folded == top[-1][0])
    return found


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_addresses_are_a_permutation_with_subtrees_in_one_piece(levels):
    places = [address(levels, level, np.arange(16**level)) for level in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(nodes_in(levels)))
    upper = levels // 2
    for root in range(16**upper if levels > 1 else 0):
        below = [places[level][root * 16 ** (level - upper) : (root + 1) * 16 ** (level - upper)] for level in range(upper, levels)]
        whole = np.concatenate(below)
        assert whole.max() - whole.min() == len(whole) - 1


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 300])
def test_a_block_holds_the_whole_tree(n):
    leaves = [h(str(i)) for i in range(n)]
    levels, height = tree(leaves), height_of(n, 3)
    nodes = laid_out([bytes.fromhex(leaf) for leaf in leaves], height)
    assert nodes[:32].hex() == levels[-1][0] and height == len(levels) - 1
    runs = runs_of(nodes, height, n)
    for i in {0, n // 2, n - 1}:
        assert siblings(runs, i) == path(levels, i)


def test_leaf_digest(spark):
    rows = spark.createDataFrame([(1, "é", None), (None, "", "x:y")], "a long, b string, c string")
    assert [r[0] for r in rows.select(leaf_digest("a", "b", "c")).collect()] == [h("1:1", "2:é", "-"), h("-", "0:", "3:x:y")]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_equals_brute_force(spark, messy, height):
    docs = messy.select("doc_id", "source", "text", leaf_digest("doc_id", "source", "text").alias("leaf")).withColumn(
        "claimed", F.when(F.col("doc_id") % 5 == 0, leaf_digest("doc_id", "source", F.lower("text")))
    )
    rows = [(r.source, r.doc_id, r.leaf, r.claimed) for r in docs.collect()]
    found = proofs(build(docs, F.col("source"), [F.col("doc_id")], F.col("doc_id"), F.col("leaf"), F.col("claimed"), height), height).collect()
    expected = manifest(rows)
    assert sorted(tuple(r)[1:] for r in found) == sorted(expected.values())
    assert {(r.id, r.leaf) for r in found} == {(r[1], r[2]) for r in rows}
    assert not all(r.verified for r in found) and any(r.verified for r in found)


def test_large_and_many_trees_in_small_blocks(spark):
    """One tree of several layers of blocks, hundreds of single leaves, and copies of one row."""
    rng = random.Random(4)
    rows = [("big", i, h(str(rng.random())), None) for i in range(700)] + [(f"s{i:03}", 1, h(f"s{i}"), None) for i in range(300)]
    rows += [("copies", 7, h("same"), h("other") if i % 2 else None) for i in range(50)]
    docs = spark.createDataFrame(rows, "source string, doc_id long, leaf string, claimed string").repartition(6)
    found = proofs(build(docs, F.col("source"), [F.col("doc_id")], F.col("doc_id"), F.col("leaf"), F.col("claimed"), 1), 1).collect()
    expected = list(manifest(rows).values())
    assert sorted(tuple(r)[1:4] for r in found) == sorted(e[:3] for e in expected)
    assert sorted((r.leaf, r.proof_sha256) for r in found) == sorted((e[0], e[3]) for e in expected)
    assert sum(r.verified for r in found) == 1000 + 25


def test_empty_and_single(spark, empty):
    assert build(empty, F.col("source"), [F.col("doc_id")], F.col("doc_id"), leaf_digest("text")) is None
    one = spark.createDataFrame([(None, None)], "source string, doc_id long")
    row = proofs(build(one, F.col("source"), [F.col("doc_id")], F.col("doc_id"), leaf_digest("doc_id"))).collect()[0]
    assert row.leaf == row.subroot == row.root == row.folded_root == h("-") and row.proof_sha256 == h("") and row.verified
