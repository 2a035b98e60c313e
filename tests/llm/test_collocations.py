import random
import re
from collections import Counter

import numpy as np
import pytest
from wordloom.llm.collocations import FmIndex, _frequent, _shards, collocations, packed, unpacked
from wordloom.plans.stages import stage

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=3, least=10, percent=50, top=2000):
    counts, before, after, total = Counter(), Counter(), Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    gram = (lang, *words[i : i + k])
                    counts[gram] += 1
                    before[gram] += i > 0
                    after[gram] += i + k < len(words)
    found = {g: a for g, a in counts.items() if a >= least and len(g) > 2}
    longer = Counter()
    for g, a in found.items():
        for k in range(2, len(g) - 1):
            for i in range(1, len(g) - k + 1):
                inner = (g[0], *g[i : i + k])
                longer[inner] = max(longer[inner], a)
    out = {}
    for (lang, *words), a in found.items():
        if 100 * longer[(lang, *words)] >= percent * a:
            continue
        cuts = [(1_000_000 * a * a // (counts[(lang, *words[:k])] * counts[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        l, r = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
        g = (lang, *words)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, before[g], after[g]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, total[lang], -score, b, f)
        for lang, rows in out.items()
        for rank, (score, a, p, l, r, b, f) in enumerate(sorted(rows)[:top], 1)
    )


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    vocabulary = ["Alpha", "beta", "gämma", "ÉTÉ", "x", "del ta", "a", "b", "😀"]
    rows = [(None, "en"), ("", "en"), (" ", None), (".,;", "und"), ("one", None)]
    for _ in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", " "]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [("New York City is big", "en")] * 15 + [("new york times", "en")] * 12 + [("a a a a a", "fr")] * 4 + [rows[9]] * 3
    return rows + [("the end of it all " * 900, "en"), ("ab" * 5000, "de")]


@pytest.mark.parametrize("shard_bytes", [1, 700, 4 << 20])
def test_equals_brute_force(spark, texts, shard_bytes):
    docs = spark.createDataFrame([(*r, 1, 2) for r in texts], "text string, lang string, rank int, n int").repartition(4)
    found = collocations(docs, shard_bytes=shard_bytes).collect()
    assert sorted(map(tuple, found)) == brute(texts)


@pytest.mark.parametrize("options", [{"most_words": 2}, {"most_words": 4, "least": 3}, {"percent": 100, "least": 2}, {"top": 3}, {"least": 300}])
def test_other_settings(spark, texts, options):
    docs = spark.createDataFrame(texts, "text string, lang string")
    found = collocations(docs, **options).collect()
    names = {"most_words": "most", "least": "least", "percent": "percent", "top": "top"}
    assert sorted(map(tuple, found)) == brute(texts, **{names[k]: v for k, v in options.items()})


def test_counts_above_64_bits(spark):
    """10^6 a a and l r pass 64 bits from a = 3 million on; the exact quotient does not."""
    rows = spark.createDataFrame([("p q. " * 40_000, "en")] * 80, "text string, lang string").repartition(8)
    (row,) = collocations(rows).collect()
    assert (row.a, row.l, row.r, row.n, row.score) == (3_200_000, 3_200_000, 3_200_000, 6_400_000, 1_000_000)


def test_no_words(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("...", "en")], "text string, lang string")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_intervals_of_the_index(seed):
    rng = np.random.default_rng(seed)
    pieces = [rng.integers(1, 5, rng.integers(1, 9)).tolist() for _ in range(60)]
    ids = np.array([w for piece in pieces for w in [*piece, 0]], np.int32)
    for depth in (1, 2, 3):
        index = FmIndex(FmIndex.transform(ids, depth))
        for k, (words, counts, before, after) in enumerate(index.intervals(depth), 1):
            expected = Counter(tuple(p[i : i + k]) for p in pieces for i in range(len(p) - k + 1))
            left = Counter(tuple(p[i : i + k]) for p in pieces for i in range(1, len(p) - k + 1))
            right = Counter(tuple(p[i : i + k]) for p in pieces for i in range(len(p) - k))
            keys = [tuple(w) for w in words.tolist()]
            assert dict(zip(keys, counts.tolist())) == expected and len(set(keys)) == len(keys)
            assert all(left[w] == b and right[w] == f for w, b, f in zip(keys, before, after))


def test_wide_ids_are_sorted_without_packing():
    ids = np.array([1 << 30, 5, 0, 5, 1 << 30, 0], np.int32)
    assert FmIndex.transform(ids, 3).tolist() == ids[np.lexsort((np.roll(ids, -2), np.roll(ids, -1), ids)) - 1].tolist()


def test_packed():
    for values in (np.arange(1000, dtype=np.uint32) * 7, np.zeros(0, np.int32), np.array([255, 0], np.uint8)):
        assert (unpacked(packed(values), values.dtype) == values).all()


def test_a_phrase_is_sent_once_whatever_shards_hold_it(spark, capsys):
    """A row for each phrase and shard grew faster than the input, as more phrases reach the least count."""
    docs = spark.createDataFrame([("Alpha beta, gamma", "en")] * 40, "text string, lang string").repartition(4)
    shards = stage(_shards(docs, 3, 1), "shards").table
    assert shards.count() == 80  # a text is cut after its comma
    sent = _frequent(shards, 120, 3, 10)
    sent.explain()
    assert "Aggregate" not in capsys.readouterr().out
    assert sorted((r.words, r.a, r.n_before, r.n_after) for r in sent.collect()) == [
        (["alpha"], 40, 0, 40), (["alpha", "beta"], 40, 0, 0), (["beta"], 40, 40, 0), (["gamma"], 40, 0, 0)
    ]
