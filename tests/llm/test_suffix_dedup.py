import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from wordloom.llm.suffix_dedup import common_prefix, dedup_passages, merge


@pytest.mark.parametrize("length, sizes", [(200, {}), (40, {"run_bytes": 3000, "merge_items": 50}), (40, {"run_bytes": 3000, "merge_items": 50, "hot_items": 3}), (5, {"run_bytes": 20000})])
def test_equals_brute_force(messy, length, sizes):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    expected = [(d, len((t or "").encode()), *x) for (d, t), x in zip(rows, brute.passages([t for _, t in rows], length))]
    found = dedup_passages(messy, length=length, **sizes).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_empty_table(empty):
    assert dedup_passages(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=8), max_size=7))
def test_merge_is_a_sort_and_knows_shared_lengths(runs):
    runs = [sorted(set(run)) for run in runs]
    shares = [[common_prefix(a, b) for a, b in zip([b"", *run], run)] for run in runs]
    order = list(merge(list(zip(runs, shares))))
    strings = [runs[r][i] for r, i, _ in order]
    assert strings == sorted(x for run in runs for x in run)
    for previous, (r, i, shared) in zip(strings, order[1:]):
        assert shared == common_prefix(previous, runs[r][i])


def test_common_prefix():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(9))) for _ in range(2))
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert all(common_prefix(a, b, k) == n for k in range(n + 1))
