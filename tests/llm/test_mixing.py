import brute
from wordloom.llm.mixing import mix, mixed_rows


def targets(sizes):
    """The rule as stated: cap at three times the size, share the excess again by weight."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += share * weight[s]
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def test_targets_and_amounts(messy):
    rows = mix(messy).collect()
    assert len(rows) == messy.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        size = len(brute.words(r.text))
        assert r.size == size and 0 <= r.copies <= 3 and (size or not r.copies)
        sizes[r.source] = sizes.get(r.source, 0) + size
        taken[r.source] = taken.get(r.source, 0) + size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), size)
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6 * (1 + expected[r.source])
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 2 * largest[s]


def test_reruns_agree_and_rows_repeat(messy):
    key = lambda frame: sorted(repr((r.doc_id, r.text, r.source, r.copies)) for r in frame.collect())
    assert key(mix(messy)) == key(mix(messy.repartition(2)))
    assert key(mix(messy)) != key(mix(messy, seed=8))
    mixed = mixed_rows(messy)
    assert mixed.columns == messy.columns
    assert mixed.count() == sum(r.copies for r in mix(messy).collect())


def test_empty_table(empty):
    assert mix(empty).collect() == []
    assert mixed_rows(empty).collect() == []
