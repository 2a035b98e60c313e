import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from wordloom.llm import toxicity
from wordloom.llm.toxicity import NEIGHBOURS, fit, held_out, score
from wordloom.llm.words import PUNCTUATION, chunks

BAD = ["nasty", "vile", "rotten"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    rows, labels = [(None, "nasty w1"), (900, None), (901, ""), (902, "...")], [(903, 1), (None, 1), (904, None)]
    for i in range(400):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, 30))]
        toxic = i % 5 == 0
        if toxic:
            text += rng.choices(BAD, k=rng.randint(1, 4))
        rng.shuffle(text)
        rows.append((i, " ".join(text).upper() if i % 7 == 0 else ", ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    labels += [labels[-1], labels[-1]]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_scores_and_evidence(corpus):
    docs, labels = corpus
    found = {r.doc_id: r for r in score(docs, fit(docs, labels)).collect()}
    assert len(found) == docs.count()
    for i in range(400):
        assert found[i].predicted == (i % 5 == 0) and 0 <= found[i].score <= 1
        assert all(e % 3 and zlib.crc32(str(e).encode()) % 5 for e in found[i].evidence)
    for i in (900, 901, 902):
        assert found[i].evidence == [] and found[i].predicted == 0


def test_neighbours_are_those_of_all_examples(corpus):
    docs, labels = corpus
    index = fit(docs, labels, terms=60)
    dense = np.zeros((len(index.doc_ids), len(index.vocabulary)))
    dense[np.repeat(np.arange(len(index.doc_ids)), np.diff(index.own_starts)), index.own_terms] = index.own_values
    rng = np.random.default_rng(1)
    for _ in range(200):
        terms = np.sort(rng.choice(len(index.vocabulary), min(len(index.vocabulary), int(rng.integers(1, 4))), replace=False))
        vector = index.vector(terms, rng.integers(1, 5, len(terms)))
        all_ = np.round(dense[:, terms] @ vector, 9)
        order = np.lexsort((np.arange(len(all_)), -all_))[:NEIGHBOURS]
        order = order[all_[order] > 0]
        got, cosines = index.nearest(terms, vector)
        assert got.tolist() == order.tolist() and np.allclose(cosines, all_[order])


def test_cosines_are_those_of_whole_texts(corpus, spark):
    docs, labels = corpus
    index = fit(docs, labels)
    place = {t: i for i, t in enumerate(index.vocabulary.tolist())}
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}

    def vector(text):
        counts = Counter((text or "").lower().replace(",", " ").replace(".", " ").split())
        hashes = {w: int(next(chunks(pa.array([w]), apart=PUNCTUATION)).word_hashes[0]) for w in counts}
        weights = {w: (1 + math.log(n)) * (index.idf[place[hashes[w]]] * index.gain[place[hashes[w]]] if hashes[w] in place else index.other_idf) for w, n in counts.items()}
        length = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / length for w, x in weights.items()}

    examples = {int(i): vector(by_id[int(i)]) for i in index.doc_ids}
    texts = ["w1 w2 w3 w4 w5", "w1 w2 w3 w4 w5 " + " ".join(f"new{i} new{i % 7}" for i in range(500)), "vile w1 unseen", "unseen"]
    found = score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), index).collect()
    for r in found:
        query = vector(texts[r.doc_id])
        expected = sorted((round(sum(x * example.get(w, 0.0) for w, x in query.items()), 9) for example in examples.values()), reverse=True)[:NEIGHBOURS]
        assert np.allclose(r.cosines, [x for x in expected if x > 0], atol=3e-9)
        assert np.allclose(r.cosines, [sum(x * examples[e].get(w, 0.0) for w, x in query.items()) for e in r.evidence], atol=3e-9)
    cosines = {r.doc_id: r.cosines for r in found}
    assert cosines[0][0] > cosines[1][0] and cosines[3] == []


def test_frequencies_cover_all_texts(corpus, spark):
    docs, labels = corpus
    index = fit(docs, labels)
    texts = [set((r.text or "").lower().replace(",", " ").replace(".", " ").split()) for r in docs.collect()]
    n = Counter(t for text in texts for t in text)
    expected = {round(math.log((1 + len(texts)) / (1 + n[w])) + 1e-6, 9) for w in BAD}
    assert expected <= {round(x, 9) for x in index.idf.tolist()}


def test_held_out_rows_are_never_examples(corpus, spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").withColumn("h", held_out("doc_id")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_empty_tables(corpus, empty):
    docs, labels = corpus
    assert score(empty, fit(docs, labels)).collect() == []
    index = fit(docs, labels.limit(0))
    assert {r.score for r in score(docs, index).collect()} == {0.5}
    assert fit(empty, labels).no_evidence == 0.5


def test_all_terms_of_the_examples_count(corpus, spark):
    docs, labels = corpus
    index = fit(docs, labels)
    terms = {t for r in docs.collect() for t in (r.text or "").lower().replace(",", " ").replace(".", " ").split()}
    assert len(index.vocabulary) == len(terms) == 83
    plain = score(spark.createDataFrame([(1, "w3 w7 w9")], "doc_id long, text string"), index).collect()[0]
    assert len(plain.evidence) == NEIGHBOURS and plain.predicted == 0


def test_a_small_sample_tells_labels_apart(spark):
    """68 labelled examples on sf0.001: too few for any term to pass a fixed level of G squared."""
    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no test tables")
    docs, labels = (spark.read.parquet(str(folder / f"{name}.parquet")) for name in ("documents", "labels"))
    index = fit(docs.select("doc_id", "text"), labels)
    assert len(index.doc_ids) == 68 and len(index.vocabulary) == 12_726
    found = score(docs.select("doc_id", "text"), index)
    held = found.join(labels.where("toxic IS NOT NULL"), "doc_id").where(held_out("doc_id")).collect()
    assert len({r.score for r in held}) > 1
    assert min(r.score for r in held if r.toxic) > max(r.score for r in held if not r.toxic)
    assert [r.predicted for r in held] == [r.toxic for r in held]


def _random_index(rng, examples, vocabulary, heavy):
    """Examples with 40 light terms each, and four of the first ``heavy`` ones, which weigh a hundred times as much."""
    term = np.concatenate([np.append(rng.choice(heavy, 4, replace=False), heavy + rng.choice(vocabulary - heavy, 40, replace=False)) for _ in range(examples)])
    postings = term, np.repeat(np.arange(examples), 44), rng.integers(1, 4, len(term))
    gain = np.where(np.arange(vocabulary) < heavy, 100.0, 1.0)
    sizes = {0: examples, 1: examples}
    return toxicity._built(np.arange(vocabulary).astype(np.uint64), np.ones(vocabulary), gain, 9, np.arange(examples), rng.integers(0, 2, examples).astype(float), postings, sizes, sizes)


def test_leading_terms_that_decide_are_enough(monkeypatch):
    """Blocks of the other terms are not looked at, which took most of a text's time."""
    rng = np.random.default_rng(4)
    index = _random_index(rng, 1000, 3000, 40)
    terms = np.append(np.arange(6), 40 + np.sort(rng.choice(2960, 400, replace=False)))
    vector = index.vector(terms, np.ones(len(terms), int))
    looked, ranges = [], toxicity._ranges
    monkeypatch.setattr(toxicity, "_ranges", lambda *a: looked.append(len((out := ranges(*a))[0])) or out)
    index.nearest(terms, vector)
    assert sum(looked) < (index.entry_starts[terms + 1] - index.entry_starts[terms]).sum() / 4


@pytest.mark.parametrize("heavy, wide", [(40, 200), (400, 3), (5, 500), (2000, 1000)])
def test_neighbours_where_all_steps_are_taken(heavy, wide):
    rng = np.random.default_rng(heavy)
    index = _random_index(rng, 500, 3000, heavy)
    dense = np.zeros((500, 3000))
    dense[np.repeat(np.arange(500), np.diff(index.own_starts)), index.own_terms] = index.own_values
    for without in (-1, 7, 499):
        for _ in range(20):
            terms = np.sort(rng.choice(3000, wide, replace=False))
            vector = index.vector(terms, rng.integers(1, 5, wide))
            cosines = np.round(dense[:, terms] @ vector, 9)
            order = np.lexsort((np.arange(500), -cosines))
            order = order[(order != without) & (cosines[order] > 0)][:NEIGHBOURS]
            got, near = index.nearest(terms, vector, without=without)
            assert np.allclose(near, cosines[order], atol=2e-9) and (got == order).sum() >= len(order) - 2


class _Counting(np.ndarray):
    """An array that counts what is taken from it."""

    taken = 0

    def __getitem__(self, key):
        got = np.asarray(super().__getitem__(key))
        _Counting.taken += got.size
        return got


def test_postings_of_frequent_terms_are_not_gone_through_for_each_text():
    """They took most of a text's time: here 5 terms that 400 of 500 examples have, among 40 that some seven have."""
    rng = np.random.default_rng(11)
    index = _random_index(rng, 500, 3000, 5)
    many = np.arange(5)
    texts = [np.append(many, 5 + np.sort(rng.choice(2995, 40, replace=False))) for _ in range(30)]
    index.examples = index.examples.view(_Counting)
    index.nearest(texts[0], index.vector(texts[0], np.ones(45, int)))  # makes what is kept for all texts
    _Counting.taken = 0
    for terms in texts:
        index.nearest(terms, index.vector(terms, np.ones(45, int)))
    counts = index.entry_first[index.entry_starts[1:]] - index.entry_first[index.entry_starts[:-1]]
    assert 0 < _Counting.taken < len(texts) * counts[many].sum() / 2


@pytest.mark.parametrize("heavy", [5, 40, 2000])
def test_neighbours_of_many_texts_at_once(heavy):
    rng = np.random.default_rng(heavy)
    index = _random_index(rng, 500, 3000, heavy)
    dense = np.zeros((500, 3000))
    dense[np.repeat(np.arange(500), np.diff(index.own_starts)), index.own_terms] = index.own_values
    ids = rng.choice(500, 300).tolist()
    texts = [(index.own_terms[a:b], index.own_values[a:b]) for a, b in zip(index.own_starts[ids], index.own_starts[np.add(ids, 1)])]
    for without in (None, ids):
        found = list(index.nearest_of(texts, without=without))
        assert len(found) == len(texts)
        for i, (terms, vector), (got, near) in zip(ids, texts, found):
            cosines = np.round(dense[:, terms] @ vector, 9)
            order = np.lexsort((np.arange(500), -cosines))
            order = order[(order != (i if without else -1)) & (cosines[order] > 0)][:NEIGHBOURS]
            assert np.allclose(near, cosines[order], atol=2e-9) and (got == order).sum() >= len(order) - 2
            assert without or got[0] == i
    assert list(index.nearest_of([])) == []
