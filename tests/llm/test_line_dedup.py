import brute
import numpy as np
import pytest
from wordloom.llm.line_dedup import dedup_lines, look_up, perfect_hash


@pytest.mark.parametrize("shard_lines", [1 << 17, 7])
def test_equals_brute_force(messy, shard_lines):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    expected = brute.line_dedup(rows)
    found = dedup_lines(messy, shard_lines=shard_lines)
    assert found.columns == [*messy.columns, "n_lines", "n_dropped"]
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(repr((d, *expected[d, t])) for d, t in rows)


def test_empty_table(empty):
    assert dedup_lines(empty).collect() == []


def test_perfect_hash_gives_every_key_its_place():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    keys[:3] = keys[3]  # keys that no level parts
    sizes, bits, rest, places = perfect_hash(keys)
    assert sorted(places.tolist()) == list(range(5000))
    prints = np.arange(5000)
    held = np.empty(5000, np.int64)
    held[places] = prints
    index = {"sizes": sizes.tobytes(), "bits": bits.tobytes(), "rest": rest.tobytes(), "fingerprints": held.tobytes()}
    assert look_up(keys, prints, index).tolist() == places.tolist()
    assert (look_up(keys, prints + 5000, index) == -1).all()
