"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled texts gives the examples; all their terms are indexed. A term weighs by TF-IDF
and by how it divides the labels, in degrees and never by a cut. Document frequencies are counted over all
texts; a text's terms that no example has count for its length too. The index has the examples' postings in
blocks with the largest weight of each term in a block, so whole blocks are passed over, never a neighbour; many
texts need no more than their leading terms and the length of the rest. The terms that most examples have are added up
for many texts at once, as a product of matrices. Distance-weighted votes become scores through rates measured on the
examples themselves, each scored without its own vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.words import PUNCTUATION, Chunk, chunks, frugal
from wordloom.plans.stages import stage

#: Bound of the fit: labelled examples of each label.
EXAMPLES = 5_000
NEIGHBOURS = 15
BLOCK = 64
BINS = 20
FOLDS = 5
#: Answers to texts that a task keeps for their copies.
ANSWERS = 10_000


#: More than 32 bits can be off in a sum of weights of unit vectors, and as a share of a sum of _FREQUENT products in 32 bits.
_SLACK, _SHARE = 2e-6, 1e-4
#: Times k: so few examples are computed in full rather than narrowed down further.
_FEW = 4
#: Terms of the first step, all of whose postings are added up.
_LEADING = 64
#: Terms with a row of weights over all examples, at most, and the share of the examples that has them, one in so many: the
#: product over all texts and examples then takes less time than the postings.
_FREQUENT, _ONE_IN = 512, 16
#: Times the examples: so few postings are all added up, which takes less time than to tell which are needed.
_SHORT = 4
#: Texts that are taken at once, with their sums over these terms.
_TOGETHER = 128


def held_out(doc_id: Column | str) -> Column:
    """Rows never learned from: crc32 of the id as text divisible by FOLDS; NULL ids are among them."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS == 0


def terms_of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count, the term before its first place): runs of letters and digits, A-Z lowered, as 64-bit hashes."""
    row = np.repeat(np.arange(len(chunk.starts)), chunk.word_counts)
    hashes = chunk.word_hashes
    before = np.append(np.zeros(1, np.uint64), hashes[:-1])[: len(hashes)]
    before[chunk.word_rows[:-1][chunk.word_counts > 0]] = 0
    order = np.lexsort((hashes, row))
    row, hashes, before = row[order], hashes[order], before[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return row[at], hashes[at], np.diff(np.append(at, len(row))), before[at]


def _known(chunk: Chunk, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the terms in the sorted vocabulary, terms by their place in it."""
    pairs, counts = np.unique(_found(chunk, vocabulary)[0], return_counts=True)
    return pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary)), counts


def _found(chunk: Chunk, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place in the vocabulary, as one number, of each word that is in it; and which words are not."""
    hashes = chunk.word_hashes
    order = np.argsort(hashes)  # places of words in order are near each other, which takes less time than the sorting
    place = np.empty(len(hashes), np.int64)
    place[order] = np.minimum(np.searchsorted(vocabulary, hashes[order]), max(0, len(vocabulary) - 1))
    known = vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
    hit = np.flatnonzero(known)
    row = np.searchsorted(chunk.word_rows, hit, side="right") - 1
    return row * len(vocabulary) + place[hit], np.flatnonzero(~known)


def _others(chunk: Chunk, unknown: np.ndarray) -> np.ndarray:
    """Per text, the sum of (1 + log count) squared over its terms among the words ``unknown``."""
    row, hashes = np.searchsorted(chunk.word_rows, unknown, side="right") - 1, chunk.word_hashes[unknown]
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))) if len(row) else row
    counts = np.diff(np.append(first, len(row)))
    return np.bincount(row[first], (1 + np.log(counts)) ** 2, minlength=len(chunk.starts))


@dataclass
class Index:
    """Examples in blocks: postings by term, each example's terms, and for each term and block its largest weight there.

    Postings by term hold weights in 32 bits, as they only tell which examples may be near; cosines come from
    the examples' own terms in 64.
    """

    vocabulary: np.ndarray
    idf: np.ndarray
    gain: np.ndarray
    other_idf: float
    doc_ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    examples: np.ndarray
    values: np.ndarray
    entry_starts: np.ndarray
    entry_block: np.ndarray
    entry_first: np.ndarray
    entry_max: np.ndarray
    own_starts: np.ndarray
    own_terms: np.ndarray
    own_values: np.ndarray
    rates: np.ndarray
    no_evidence: float

    def vector(self, terms: np.ndarray, counts: np.ndarray, others: float = 0.0) -> np.ndarray:
        """TF-IDF weights times the terms' gains, parts of a vector of unit length.

        ``others`` are the text's terms that no example has: they count for its length, with a gain of 1 and
        the frequency of a term that is in a single text.
        """
        made = (1 + np.log(counts)) * self.idf[terms] * self.gain[terms]
        length = np.sqrt((made * made).sum() + others * self.other_idf**2)
        return made / length if length else made

    @cached_property
    def _query(self) -> np.ndarray:
        return np.zeros(len(self.vocabulary))

    @cached_property
    def _term_max(self) -> np.ndarray:
        """Largest weight of a term in any block; each has an entry."""
        return np.maximum.reduceat(self.entry_max, self.entry_starts[:-1]) if len(self.entry_max) else np.zeros(0)

    @cached_property
    def _frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """Each term's row, -1 for terms that are not frequent, and the rows: a frequent term's weights in all examples."""
        counts = np.diff(self.entry_first[self.entry_starts])
        most = np.argsort(-counts, kind="stable")[:_FREQUENT]
        most = most[counts[most] * _ONE_IN >= len(self.doc_ids)]
        row = np.full(len(self.vocabulary), -1, np.int32)
        row[most] = np.arange(len(most))
        weights = np.zeros((len(most), -(-len(self.doc_ids) // BLOCK) * BLOCK), np.float32)
        for i, (start, end) in enumerate(zip(self.entry_first[self.entry_starts[most]], self.entry_first[self.entry_starts[most + 1]])):
            weights[i, self.examples[start:end]] = self.values[start:end]
        return row, weights

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_query", "_term_max", "_frequent")}

    def frequent_sums(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For texts as (terms, vector), a row each: what their frequent terms add to the cosine with each example."""
        row, weights = self._frequent
        own = np.zeros((len(texts), len(weights)), np.float32)
        for i, (terms, vector) in enumerate(texts):
            rows = row[terms]
            own[i, rows[rows >= 0]] = vector[rows >= 0]
        return own @ weights

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, without: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same as ``nearest`` for each of many texts."""
        for first in range(0, len(texts), _TOGETHER):
            some = texts[first : first + _TOGETHER]
            for i, (text, sums) in enumerate(zip(some, self.frequent_sums(some)), first):
                yield self.nearest(*text, k, without[i] if without else -1, sums)

    def nearest(
        self, terms: np.ndarray, vector: np.ndarray, k: int = NEIGHBOURS, without: int = -1, sums: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine over 0, ties to the lower number, and their cosines.

        Frequent terms come first, with ``sums`` if these are known. The others go all at once if they have few postings,
        or else by the most that they can add, some at once and then more. After each step the k-th partial sum
        is a lower bound. No example can add more than the length of the vector's terms to come, as it has a length
        of 1 itself; where that leaves more than a few, a block whose best partial sum and the largest weights of
        the terms to come in it do not reach the bound is passed over from then on. What is left in the end is
        computed in full.
        """
        blocks = -(-len(self.doc_ids) // BLOCK)
        sums = self.frequent_sums([(terms, vector)])[0] if sums is None else sums
        rest = np.flatnonzero(self._frequent[0][terms] < 0)
        low, high = self.entry_starts[terms[rest]], self.entry_starts[terms[rest] + 1]
        starts, ends = self.entry_first[low], self.entry_first[high]
        size, at, length = 2 * _LEADING, len(rest), np.zeros(len(rest) + 1)
        if (ends - starts).sum() > _SHORT * len(sums):
            order = np.argsort(-vector[rest] * self._term_max[terms[rest]], kind="stable")
            rest, low, high, starts, ends = (x[order] for x in (rest, low, high, starts, ends))
            length = np.sqrt(np.append(np.cumsum((vector[rest] * vector[rest])[::-1])[::-1], 0.0))
            at = min(_LEADING, len(rest))
        weight = vector[rest]
        short = weight.astype(np.float32)  # as the postings' weights are; a product of both kinds takes several times as long
        counts = ends[:at] - starts[:at]
        places = np.repeat(starts[:at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        sums = sums + np.bincount(self.examples[places], np.repeat(short[:at], counts) * self.values[places], minlength=len(sums))
        live, to_come, entries = np.ones(blocks, bool), np.full(blocks, np.inf), None
        while True:
            if without >= 0:
                sums[without] = -1.0
            kth = np.partition(sums, -k)[-k] if len(sums) >= k else 0.0
            could, live = _within(sums, live, np.minimum(to_come, length[at]), kth)
            if at == len(rest) or kth > 0 and np.count_nonzero(could) <= _FEW * k:
                break
            if entries is None:
                entries, of = _ranges(low[at:], high[at:])
                kept = np.flatnonzero(live[self.entry_block[entries]])
                entries, of = entries[kept], of[kept] + at
                block, most = self.entry_block[entries], weight[of] * self.entry_max[entries]
                to_come = np.bincount(block, most, minlength=blocks)
                could, live = _within(sums, live, np.minimum(to_come, length[at]), kth)
                if kth > 0 and np.count_nonzero(could) <= _FEW * k:
                    break
            end = min(at + size, len(rest))
            step = slice(*np.searchsorted(of, [at, end]))
            to_come -= np.bincount(block[step], most[step], minlength=blocks)
            kept = np.flatnonzero(live[block[step]]) + step.start
            places, which = _ranges(self.entry_first[entries[kept]], self.entry_first[entries[kept] + 1])
            sums += np.bincount(self.examples[places], short[of[kept]][which] * self.values[places], minlength=len(sums))
            at, size = end, 2 * size
        found = np.flatnonzero(could[: len(self.doc_ids)])
        self._query[terms] = vector
        starts, ends = self.own_starts[found], self.own_starts[found + 1]
        own, value = _slices(starts, ends, self.own_terms, self.own_values)
        cosines = np.round(np.bincount(np.repeat(np.arange(len(found)), ends - starts), self._query[own] * value, minlength=len(found)), 9)
        self._query[terms] = 0
        found, cosines = found[cosines > 0], cosines[cosines > 0]
        best = np.lexsort((found, -cosines))
        if without >= 0:
            best = best[found[best] != without]
        return found[best[:k]], cosines[best[:k]]

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        """Share of the votes for label 1; a vote weighs by nearness and by what its label's sample stands for."""
        weight = self.weights[found] / (1.05 - cosines)
        return float((weight * self.labels[found]).sum() / weight.sum())

    def score(self, vote: float | None) -> float:
        return self.no_evidence if vote is None else float(np.interp(vote, (np.arange(BINS) + 0.5) / BINS, self.rates))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each start up to its end, and which range each is of."""
    counts = (ends - starts).astype(np.int64)
    of = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(of)) + (starts - (np.cumsum(counts) - counts))[of], of


def _slices(starts: np.ndarray, ends: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    """What each array holds from each start up to its end, for ranges that are few and long."""
    cuts = list(map(slice, starts.tolist(), ends.tolist()))
    return [np.concatenate([array[:0], *[array[cut] for cut in cuts]]) for array in arrays]


def _within(sums: np.ndarray, live: np.ndarray, more: np.ndarray, kth: float) -> tuple[np.ndarray, np.ndarray]:
    """Which examples of live blocks could come to the k-th sum with what their block can add, and which blocks hold one."""
    if kth <= 0:
        return sums > 0, live
    could = (sums.reshape(len(live), BLOCK) >= (kth * (1 - _SHARE) - _SLACK - more)[:, None]) & live[:, None]
    return could.ravel(), could.any(axis=1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES, terms: int | None = None) -> Index:
    """The index over a sample of the labelled rows that are not held out, by all their terms.

    At most ``examples`` rows of each label, those with the smallest hash of their id. NULL labels and
    labels of no document are left out, the largest label of an id counts; without any label every score is 0.5.
    ``terms`` keeps only that many terms, those that divide the labels best; op9 keeps all.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(label).alias("label"))
    known = stage(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "toxicity_labels").table
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    sample = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
        sample = part if sample is None else sample.unionByName(part)
    sample = stage(sample, "toxicity_sample").table
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text"), lower=True, apart=PUNCTUATION):
                row, term, n, before = terms_of(chunk)
                at = pa.array(row + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("label").take(at), pa.array(term.view(np.int64)), pa.array(n),
                     pa.array(before.view(np.int64))],
                    names=["doc_id", "label", "term", "n", "before"],
                )

    postings = stage(texts.select("doc_id", "label", "text").mapInArrow(frugal(counted), "doc_id long, label int, term long, n long, before long"), "toxicity_terms").table
    in_sample = {value: min(examples, sizes.get(value, 0)) for value in (0, 1)}
    vocabulary, gain = _vocabulary(postings, in_sample, terms)
    frequency, total = _frequencies(docs, vocabulary)
    idf = np.log((1 + total) / (1 + frequency)) + 1e-6
    chosen = sample.orderBy("doc_id").collect()
    doc_ids = np.array([row["doc_id"] for row in chosen], np.int64)
    labels_ = np.array([row["label"] for row in chosen], float)
    return _calibrated(docs.sparkSession, _built(vocabulary, idf, gain, total, doc_ids, labels_, _placed(postings, vocabulary, doc_ids), sizes, in_sample))


def _placed(postings: DataFrame, vocabulary: np.ndarray, doc_ids: np.ndarray) -> list[np.ndarray]:
    """Term and example, by their places in the sorted vocabulary and doc_ids, and count: 12 bytes each for the driver."""
    shared = postings.sparkSession.sparkContext.broadcast((vocabulary, doc_ids))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, doc_ids = shared.value
        for batch in batches:
            hashes = batch.column("term").to_numpy().view(np.uint64)
            place = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
            known = np.flatnonzero(vocabulary[place] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
            example = np.searchsorted(doc_ids, batch.column("doc_id").to_numpy()[known])
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[known].astype(np.int32)), pa.array(example.astype(np.int32)), batch.column("n").take(pa.array(known))],
                names=["term", "example", "n"],
            )

    once = postings.groupBy("doc_id", "term").agg(F.max("n").cast("int").alias("n"))
    rows = once.mapInArrow(frugal(placed), "term int, example int, n int").toArrow()
    return [np.array(rows.column(c).to_numpy()) for c in ("term", "example", "n")]


def _vocabulary(postings: DataFrame, in_sample: dict[int, int], most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the terms, and how much each weighs for telling labels apart: (1 + G squared) squared, so 1 at least.

    G squared is the smaller one of that by the texts a term is in, and that by the terms that it follows, each
    counted once: copies of a text or passage are many texts, but one context.
    """
    n = {v: float(max(1, c)) for v, c in in_sample.items()}
    one, zero = F.col("label").cast("double"), 1.0 - F.col("label").cast("double")
    contexts = postings.groupBy("term", "before").agg(
        F.sum(one).alias("a"), F.sum(zero).alias("b"), F.max(one).alias("a1"), F.max(zero).alias("b1")
    )
    counts = contexts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("a", "b", "a1", "b1")])

    def g2(a: Column, b: Column) -> Column:
        share = (a + b) / (n[0] + n[1])
        parts = [(a, share * n[1]), (b, share * n[0]), (n[1] - a, (1 - share) * n[1]), (n[0] - b, (1 - share) * n[0])]
        return 2 * sum((F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0) for seen, due in parts), F.lit(0.0))

    least = F.least(g2(F.col("a"), F.col("b")), g2(F.col("a1"), F.col("b1")))
    weighed = counts.select("term", F.pow(1 + F.greatest(least, F.lit(0.0)), 2).alias("gain"))
    if most is not None:
        weighed = weighed.orderBy(F.desc("gain"), "term").limit(most)
    found = weighed.toArrow()
    terms, gain = found.column("term").to_numpy().view(np.uint64), found.column("gain").to_numpy()
    order = np.argsort(terms)
    return terms[order], gain[order]


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all texts each term is, and how many texts there are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for chunk in chunks(batch.column("text"), lower=True, apart=PUNCTUATION):
                seen += np.bincount(_known(chunk, vocabulary)[1], minlength=len(vocabulary))
        at = np.append(-1, np.flatnonzero(seen))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(texts, seen[at[1:]]))], names=["term", "n"])

    sums = docs.select("text").mapInArrow(frugal(counted), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(vocabulary) + 1, np.int64)  # the last one is that of term -1, all texts
    counts[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    return counts[:-1].astype(float), int(counts[-1])


def _built(vocabulary, idf, gain, total, doc_ids, labels, postings, sizes, in_sample) -> Index:
    term, example, n = postings
    value = (1 + np.log(n)) * (idf * gain)[term]
    place = _alike_together(example, term, value, len(doc_ids))
    doc_ids[place], labels[place] = doc_ids.copy(), labels.copy()
    example = place[example]
    lengths = np.sqrt(np.bincount(example, value * value, minlength=len(doc_ids)))
    value /= lengths[example]
    order = np.lexsort((term, example))
    own = np.searchsorted(example[order], np.arange(len(doc_ids) + 1)), term[order].astype(np.int32), value[order]
    order = np.lexsort((example, term))
    example, term, value = example[order], term[order], value[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (example[1:] // BLOCK != example[:-1] // BLOCK)
    first = np.flatnonzero(new)
    highest = np.maximum.reduceat(value, first) if len(first) else np.zeros(0)
    stands = np.array([sizes.get(v, 0) / max(1, in_sample[v]) for v in (0, 1)])
    return Index(
        vocabulary, idf, gain, float(np.log((1 + total) / 2) + 1e-6), doc_ids, labels, stands[labels.astype(int)] if len(labels) else labels,
        example.astype(np.int32), value.astype(np.float32), np.searchsorted(term[first], np.arange(len(vocabulary) + 1)), (example[first] // BLOCK).astype(np.int32),
        np.append(first, len(term)).astype(np.int32), highest * (1 + 1e-9), *own, np.full(BINS, 0.5), 0.5,
    )


def _alike_together(example: np.ndarray, term: np.ndarray, value: np.ndarray, examples: int, leading: int = 8) -> np.ndarray:
    """New numbers of the examples by their weightiest terms, so that a block's largest weights are near those of all in it."""
    leaders = np.full((leading, examples), -1)
    for low in range(0, examples, 512):  # some at once, for the driver's memory
        some = np.flatnonzero((example >= low) & (example < low + 512))
        some = some[np.lexsort((term[some], -value[some], example[some]))]
        rank = np.arange(len(some)) - np.searchsorted(example[some], example[some])
        top = some[rank < leading]
        leaders[rank[rank < leading], example[top]] = term[top]
    place = np.zeros(examples, np.int32)
    place[np.lexsort((np.arange(examples), *leaders[::-1]))] = np.arange(examples)
    return place


def _votes(spark: SparkSession, index: Index) -> dict[int, float]:
    """Each example's vote without itself, for those that have neighbours; the examples are spread over the tasks."""
    shared = spark.sparkContext.broadcast(index)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            numbers, votes = [], []
            ids = [i for i in batch.column("id").to_pylist() if index.own_starts[i + 1] > index.own_starts[i]]
            own = [slice(index.own_starts[i], index.own_starts[i + 1]) for i in ids]
            for i, (found, cosines) in zip(ids, index.nearest_of([(index.own_terms[o], index.own_values[o]) for o in own], without=ids)):
                if len(found):
                    numbers.append(i)
                    votes.append(index.vote(found, cosines))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(votes, pa.float64())], names=["id", "vote"])

    rows = spark.range(0, len(index.doc_ids), numPartitions=4 * spark.sparkContext.defaultParallelism).mapInArrow(frugal(voted), "id long, vote double")
    found = {row["id"]: row["vote"] for row in rows.collect()}  # as many as examples at most
    shared.destroy()
    return found


def _calibrated(spark: SparkSession, index: Index) -> Index:
    """Rates of label 1 by vote, each example scored without itself; rising with the vote, and smoothed."""
    hits, ones = np.zeros(BINS), np.zeros(BINS)
    none, none_ones = 0.0, 0.0
    votes = _votes(spark, index) if len(index.doc_ids) else {}
    for i in range(len(index.doc_ids)):
        weight, label = index.weights[i], index.labels[i]
        if i in votes:
            b = min(BINS - 1, int(votes[i] * BINS))
            hits[b] += weight
            ones[b] += weight * label
        else:
            none += weight
            none_ones += weight * label
    middle = (np.arange(BINS) + 0.5) / BINS
    rates = (ones + 4 * middle) / (hits + 4)
    pooled: list[list[float]] = []
    for rate, size in zip(rates, hits + 4):
        pooled.append([rate, size, 1])
        while len(pooled) > 1 and pooled[-2][0] > pooled[-1][0]:
            r, s, n = pooled.pop()
            p = pooled[-1]
            pooled[-1] = [(p[0] * p[1] + r * s) / (p[1] + s), p[1] + s, p[2] + n]
    index.rates = np.repeat([p[0] for p in pooled], [int(p[2]) for p in pooled])
    if len(index.doc_ids):
        base = (index.weights @ index.labels + 1) / (index.weights.sum() + 2)
        index.no_evidence = float((none_ones + 2 * base) / (none + 2))  # no such example, or few: the rate of all
    return index


def score(docs: DataFrame, index: Index, neighbours: int = NEIGHBOURS) -> DataFrame:
    """The columns of docs but ``text``, with score, predicted, and the evidence: example ids and cosines.

    A text without a term of the examples, empty and NULL ones too, gets the rate of such examples and no
    evidence. Nothing is shuffled. Columns of docs named like a new one are replaced.
    """
    new = ["score", "evidence", "cosines"]
    kept = [c for c in docs.columns if c not in ["text", "predicted", *new]]
    schema = docs.select(*kept).limit(0).withColumns({
        "score": F.lit(0.0), "evidence": F.lit(None).cast("array<long>"), "cosines": F.lit(None).cast("array<double>")
    }).schema
    shared = docs.sparkSession.sparkContext.broadcast(index)  # the terms of the examples, whatever the input

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen = shared.value, {}
        # A few texts at a time: arrays over all bytes of many take more memory than the index does.
        for batch in (batch.slice(at, _TOGETHER) for batch in batches for at in range(0, batch.num_rows, _TOGETHER)):
            for chunk in chunks(batch.column("text"), lower=True, apart=PUNCTUATION):
                pairs, unknown = _found(chunk, index.vocabulary)
                pairs, n = np.unique(pairs, return_counts=True)
                row, term = pairs // max(1, len(index.vocabulary)), pairs % max(1, len(index.vocabulary))
                others = _others(chunk, unknown)
                cuts = np.searchsorted(row, np.arange(len(chunk.starts) + 1)).tolist()
                texts = [(term[start:end], n[start:end], other) for start, end, other in zip(cuts, cuts[1:], others)]
                keys = [blake2b(t.tobytes() + c.tobytes() + other.tobytes(), digest_size=16).digest() for t, c, other in texts]
                if len(seen) + len(keys) > ANSWERS:
                    seen.clear()
                new_texts = {key: text for key, text in zip(keys, texts) if key not in seen}
                seen.update(zip(new_texts, _answers(index, list(new_texts.values()), neighbours)))
                scores, evidence, cosines = map(list, zip(*[seen[key] for key in keys]))
                rows = batch.slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in kept], pa.array(scores), pa.array(evidence, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))],
                    names=[*kept, *new],
                )

    made = docs.select(*kept, "text").mapInArrow(frugal(scored), schema)
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _answers(index: Index, texts: list[tuple[np.ndarray, np.ndarray, float]], k: int) -> Iterator[tuple[float, list[int], list[float]]]:
    """Score and evidence of texts as (terms, counts, others)."""
    vectors = [(terms, index.vector(terms, counts, others)) for terms, counts, others in texts]
    near = index.nearest_of([text for text in vectors if len(text[0])], k)
    for terms, _ in vectors:
        found, cosines = next(near) if len(terms) else ([], [])
        if len(found):
            yield index.score(index.vote(found, cosines)), index.doc_ids[found].tolist(), cosines.tolist()
        else:
            yield index.score(None), [], []
