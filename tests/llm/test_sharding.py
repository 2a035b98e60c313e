import numpy as np
from wordloom.llm.sharding import jump, shards


def reference(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_function():
    keys = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, 2000)
    for n in (1, 2, 8, 9, 1000):
        assert jump(keys, n).tolist() == [reference(int(k) % (1 << 64), n) for k in keys]


def test_appended_shards_take_rows_only_into_themselves():
    keys = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 20000)
    before, after = jump(keys, 8), jump(keys, 9)
    assert set(after[before != after]) == {8}
    assert abs((before != after).mean() - 1 / 9) < 0.02


def test_slots(messy, empty):
    found = shards(messy, ["doc_id"], 8, ["doc_id", "text"], ["doc_id", "text"]).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found))) == sorted(map(repr, ((r.doc_id, r.text) for r in messy.collect())))
    by_shard, of = {}, {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert of.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard) and r.grown_shard in (r.shard, 8)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert shards(empty, ["doc_id"], 8, ["doc_id"], ["doc_id"]).collect() == []
