import math

import numpy as np
import pytest
from wordloom.llm.embedding_dedup import grid_dims, near_vectors, rotation, turned

COLUMNS = "vec_id long, embedding array<double>, label string, n_links int, cell int"


def scaled(vector):
    return np.array(vector, float) / max(map(abs, vector))


def brute(rows, least):
    """{position: (n_links, component)}"""
    fit = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(fit):
        a = scaled(rows[i][1])
        for j in fit[:n]:
            b = scaled(rows[j][1])
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least_id = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least_id[find(i)] = min(least_id.get(find(i), vec_id), vec_id)
    return sorted((-1 if r[0] is None else r[0], links[i], -1 if least_id.get(find(i)) is None else least_id[find(i)]) for i, r in enumerate(rows))


def found(spark, rows, least, **options):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], COLUMNS).repartition(3)
    return sorted(tuple(-1 if x is None else x for x in r) for r in near_vectors(table, least, **options).collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for dims, labels in ((12, ["a", "b"]), (5, ["a"])):
        centres = rng.standard_normal((12, dims))
        for i in range(90):
            spread = [0.02, 0.08, 0.16][i % 3]
            rows.append((centres[i % 12] + spread * rng.standard_normal(dims), labels[i % len(labels)]))
    rows += [(rows[0][0], rows[0][1])] * 7 + [(rows[1][0] * 1e200, rows[1][1]), (rows[1][0] * 1e-200, rows[1][1])]
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(rows)]
    odd = [[0.0] * 12, [None] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, None, []]
    rows += [(1000 + i, v, "a") for i, v in enumerate(odd)] + [(2000, rows[0][1], None), (None, rows[0][1], "a"), (5, rows[5][1], "b"), (None, None, None)]
    return rows


@pytest.mark.parametrize("least, block, cell", [(0.98, 8, 4096), (0.98, 3, 8), (0.9, 4, 16), (0.7, 8, 4096), (0.999, 5, 10)])
def test_equals_brute_force(spark, vectors, least, block, cell):
    assert found(spark, vectors, least, block=block, cell=cell) == brute(vectors, least)


def test_a_dense_group_is_counted_in_tiles(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.05 * rng.standard_normal(16)).tolist(), "x") for i in range(150)]
    assert found(spark, rows, 0.98, cell=16) == brute(rows, 0.98)


def test_pairs_at_the_border_of_the_budget(spark):
    """Pairs whose cosine is just at, above and under the least one."""
    rows = []
    for i, angle in enumerate(np.arccos(0.98) + np.array([-1e-6, -1e-9, 1e-9, 1e-6])):
        base = rotation(6)[i]
        side = rotation(6)[(i + 1) % 6]
        rows += [(2 * i, base.tolist(), str(i)), (2 * i + 1, (np.cos(angle) * base + np.sin(angle) * side).tolist(), str(i))]
    assert [r[1] for r in found(spark, rows, 0.98)] == [1, 1, 1, 1, 0, 0, 0, 0]


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert near_vectors(empty).collect() == []
    for least in (0.5, 1.0):
        with pytest.raises(ValueError, match="cosine"):
            near_vectors(empty, least)


def test_rotation_and_grids():
    r = rotation(64)
    assert np.allclose(r @ r.T, np.eye(64))
    v = np.random.default_rng(1).standard_normal((20, 64)) * 5
    assert (turned(v)[3:4] == turned(v[3:4])).all() and np.allclose(np.linalg.norm(turned(v), axis=1), 1)
    cuts = [grid_dims(n, 64, 0.14, 8) for n in (1, 1_000, 100_000, 10_000_000)]
    assert cuts == sorted(cuts) and cuts[0] == 1 and cuts[-1] > 3
