"""Phrases of a few words that stand together more often than their parts would, per language.

Texts are cut into shards of some megabytes, and each shard becomes an FM-index over its word ids: the
Burrows-Wheeler transform of its pieces, in suffix order up to the depth of the longest phrase. An interval
of that order is a phrase; it is extended to the left by the symbols of the transform in it, to the right
through the inverse of the last-to-first mapping, and all intervals of a depth are extended at once. Counts,
and how often a phrase has a neighbour on its left and right, are added up across shards.

Most phrases are rare and never reported, so what crosses the network is a 64-bit hash and the counts of each
phrase and shard, in blobs by hash range: the phrases of a shard are as many whatever the corpus, so this grows as
the input does. Where a hash's counts reach the least count, one of the shards that hold it is told the sums and
sends the phrase itself, once. A phrase is known by its length and these 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.words import chunks, frugal, give_back, mixed, prefix_hashes, span_hashes
from wordloom.plans.stages import stage

SHARD_BYTES = 4 << 20
#: Words of the corpus that a hash range stands for at most: some 100 MB in the task that adds it up.
RANGE_WORDS = 2 << 20
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_APART = np.zeros(256, bool)
_APART[[0x20, 0x09, *range(0x0A, 0x0E), *b".,;:!?"]] = True
_BREAKS = _APART.copy()
_BREAKS[[0x20, 0x09]] = False
_U = np.uint64
SHARD = "shard long, n_words long, langs array<string>, lang_words array<bigint>, dictionary binary, word_langs binary, bwt binary"


class FmIndex:
    """Burrows-Wheeler transform of word ids with 0 after every piece, and extension of intervals in both directions."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        self.first = np.repeat(np.arange(len(counts := np.bincount(bwt)), dtype=bwt.dtype), counts)
        #: Where the suffix that follows by one word stands: the inverse of the last-to-first mapping.
        self.onward = np.argsort(bwt, kind="stable").astype(np.int32)

    @staticmethod
    def transform(ids: np.ndarray, depth: int) -> np.ndarray:
        """The transform in suffix order up to ``depth`` words; ids end with 0."""
        bits = max(1, int(ids.max(initial=0)).bit_length())
        words = [np.roll(ids, -d) for d in range(depth)]
        if bits * depth < 64:
            key = np.zeros(len(ids), _U)
            for w in words:
                key = key << _U(bits) | w.astype(_U)
            order = np.argsort(key, kind="stable")
        else:
            order = np.lexsort(words[::-1])
        return ids[order - 1]

    def intervals(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For phrases of 1 to ``depth`` words: their words by row, counts, and occurrences with a word before and after."""
        n = len(self.bwt)
        at, word = np.arange(n, dtype=np.int32), self.first
        words: list[np.ndarray] = []
        edge = np.zeros(n, bool)
        edge[:1] = True
        whole = np.ones(n, bool)
        before = np.append(np.int32(0), np.cumsum(self.bwt != 0, dtype=np.int32))
        for _ in range(depth):
            words.append(word)
            whole = whole & (word != 0)
            edge = edge.copy()
            edge[1:] |= word[1:] != word[:-1]
            starts = np.flatnonzero(edge)
            ends = np.append(starts[1:], n)
            at = self.onward[at]
            word = self.first[at]
            after = np.append(np.int32(0), np.cumsum(word != 0, dtype=np.int32))
            kept = whole[starts]
            lo, hi = starts[kept], ends[kept]
            yield np.array([w[lo] for w in words]).T, hi - lo, before[hi] - before[lo], after[hi] - after[lo]


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Texts and languages of a batch; texts above ``most`` bytes are cut after a byte that ends a piece."""
    for batch in batches:
        texts, langs = [], []
        for text, lang in zip(batch["text"].cast(pa.large_binary()).to_pylist(), batch["lang"].to_pylist()):
            text = text or b""
            while len(text) > most and (end := _BREAK.search(text, most)):
                texts.append(text[: end.end()])
                langs.append(lang)
                text = text[end.end() :]
            texts.append(text)
            langs.append(lang)
        yield pa.array(texts, pa.large_binary()), langs


def _shards(docs: DataFrame, depth: int, shard_bytes: int) -> DataFrame:
    """Rows of SHARD: the index, and its dictionary with a line feed after each word."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for texts, langs in _cut(batches, shard_bytes):
            for chunk in chunks(texts, lower=True, chunk_bytes=shard_bytes, apart=_APART):
                starts, ends = chunk.spans
                if not len(starts):
                    continue
                names = sorted(set(langs[chunk.first : chunk.last]))
                number = {name: i for i, name in enumerate(names)}
                lang = np.repeat(np.array([number[x] for x in langs[chunk.first : chunk.last]]), chunk.word_counts)
                offsets = np.append(0, np.cumsum(ends - starts))
                letters = chunk.data[~_APART[chunk.data]]
                words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
                # A word of two languages is two words.
                both, ids = np.unique(words.indices.to_numpy().astype(np.int64) * len(names) + lang, return_inverse=True)
                dictionary = words.dictionary.take(pa.array(both // len(names))).to_pylist()
                breaks = np.cumsum(_BREAKS[chunk.data], dtype=np.int32)
                ends_piece = np.append(np.flatnonzero(np.diff(breaks[starts])), len(starts) - 1)
                sequence = np.insert(ids + 1, ends_piece + 1, 0).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([made], pa.int64()), "n_words": [len(starts)], "langs": [names],
                    "lang_words": pa.array([np.bincount(lang, minlength=len(names))]),
                    "dictionary": [b"\n".join(dictionary)], "word_langs": [packed((both % len(names)).astype(np.int32))],
                    "bwt": [packed(FmIndex.transform(sequence, depth))],
                })
                made += 1

    return docs.select("text", "lang").mapInArrow(frugal(index), SHARD)


def packed(values: np.ndarray) -> bytes:
    """Integers in few bytes: equal places of all numbers stand together, then zstd."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _hashed(row: dict) -> np.ndarray:
    """64 bits for each id of a shard, the same in all shards; 0 stands for the end of a piece."""
    blob = np.frombuffer(row["dictionary"], np.uint8)
    ends = np.append(np.flatnonzero(blob == 10), len(blob))
    starts = np.append(0, ends[:-1] + 1)
    names = [np.frombuffer((lang or "").encode(), np.uint8) for lang in row["langs"]]
    langs = np.array([span_hashes(prefix_hashes(n), np.array([0]), np.array([len(n)]))[0] for n in names], _U)
    words = span_hashes(prefix_hashes(blob), starts, ends)
    return np.append(_U(0), mixed(words ^ mixed(langs[unpacked(row["word_langs"], np.int32)] + _U(1))))


def _phrases(row: dict, depth: int, ranges: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By phrase length: words, counts, neighbours before and after, hash range and hash, sorted by these two."""
    index, word_hash = FmIndex(unpacked(row["bwt"], np.int32)), _hashed(row)
    for words, counts, before, after in index.intervals(depth):
        found = np.zeros(len(words), _U)
        for column in words.T:
            found = mixed(found * _U(3) + word_hash[column])
        order = np.argsort(found, kind="stable")
        found = found[order]
        part = (found >> _U(32)) * _U(ranges) >> _U(32)
        yield words[order], counts[order], before[order], after[order], part.astype(np.int64), found


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _frequent(shards: DataFrame, n_words: int, depth: int, least: int) -> DataFrame:
    """(lang, words, a, n_before, n_after) of all phrases that stand at least ``least`` times in a language."""
    partitions = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-n_words // RANGE_WORDS))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                for length, (_, counts, before, after, part, hashes) in enumerate(_phrases(row, depth, ranges), 1):
                    # Most phrases have a word on both sides, so what lacks one is few and packs well.
                    three = np.array([counts, counts - before, counts - after]).astype(np.int32)
                    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(part[cuts[:-1]], pa.int64()), "shard": pa.array([row["shard"]] * (len(cuts) - 1), pa.int64()),
                        "length": pa.array([length] * (len(cuts) - 1), pa.int32()),
                        "hashes": pa.array([packed(np.diff(hashes[i:j], prepend=_U(0))) for i, j in zip(cuts, cuts[1:])], pa.binary()),
                        "counts": pa.array([packed(three[:, i:j].ravel()) for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    })

    def resolve(table: pa.Table) -> pa.Table:
        hashes = [np.cumsum(unpacked(x, _U), dtype=_U) for x in table["hashes"].to_pylist()]
        sizes = [len(h) for h in hashes]
        whole = np.concatenate(hashes)
        order = np.argsort(whole, kind="stable")
        whole = whole[order]
        starts = np.flatnonzero(np.append(True, whole[1:] != whole[:-1]))
        del hashes, whole
        three = [unpacked(x, np.int32).reshape(3, -1) for x in table["counts"].to_pylist()]
        totals = [np.add.reduceat(np.concatenate([x[i] for x in three])[order], starts, dtype=np.int64) for i in range(3)]
        enough = totals[0] >= least
        # The first blob that holds a phrase tells it.
        teller = order[starts[enough]]
        told = np.argsort(teller)
        teller, totals = teller[told], [t[enough][told] for t in totals]
        ends = np.cumsum(sizes)
        cuts = np.append(0, np.searchsorted(teller, ends))
        some = np.flatnonzero(np.diff(cuts))
        of = [slice(cuts[i], cuts[i + 1]) for i in some]
        answer = table.select(["shard", "part", "length"]).take(pa.array(some))
        answer = answer.append_column("places", pa.array([packed((teller[x] - (ends[i] - sizes[i])).astype(np.int32)) for i, x in zip(some, of)], pa.binary()))
        return answer.append_column("totals", pa.array([packed(np.concatenate([t[x] for t in totals])) for x in of], pa.binary()))

    proposed = shards.select("shard", "langs", "dictionary", "word_langs", "bwt").mapInArrow(frugal(propose), "part long, shard long, length int, hashes binary, counts binary")
    answers = proposed.groupBy("part", "length").applyInArrow(resolve, "shard long, part long, length int, places binary, totals binary")

    def send(shard: pa.Table, answers: pa.Table) -> pa.Table:
        asked: dict[int, list[dict]] = {}
        for r in _rows(answers):
            asked.setdefault(r["length"], []).append(r)
        none = np.zeros((3, 0), np.int64)
        found: list[pa.Table] = []
        for row in _rows(shard):
            names = pa.array([name.decode() for name in row["dictionary"].split(b"\n")])
            langs, word_langs = pa.array(row["langs"]), unpacked(row["word_langs"], np.int32)
            for length, (words, _, _, _, part, _) in enumerate(_phrases(row, depth, ranges) if asked else [(np.zeros((0, 1), np.int64), *[None] * 5)], 1):
                rows = asked.get(length, [])
                chosen = np.concatenate([none[0], *[np.searchsorted(part, r["part"]) + unpacked(r["places"], np.int32) for r in rows]])
                a, first, last = np.concatenate([none, *[unpacked(r["totals"], np.int64).reshape(3, -1) for r in rows]], axis=1)
                words = words[chosen]
                found.append(pa.table({
                    "lang": langs.take(pa.array(word_langs[words[:, 0] - 1])),
                    "phrase": pc.binary_join_element_wise(*[names.take(pa.array(column - 1)) for column in words.T], " "),
                    **{k: pa.array(v) for k, v in (("a", a), ("n_before", a - first), ("n_after", a - last))},
                }))
        give_back()
        return pa.concat_tables(found)

    sent = shards.select("shard", "langs", "dictionary", "word_langs", "bwt").groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        send, "lang string, phrase string, a long, n_before long, n_after long"
    )
    # A word holds no blank, so the phrase tells its words.
    return sent.select("lang", F.split("phrase", " ").alias("words"), "a", "n_before", "n_after")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", most_words: int = 3, least: int = 10, percent: int = 50, top: int = 2000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, n_before, n_after: the ``top`` phrases of each language.

    A phrase is 2 to ``most_words`` consecutive words of a piece, met at least ``least`` times (a). Of its
    cuts into two parts, met l and r times, the one with the lowest score floor(10^6 a a / (l r)) counts,
    the shortest first part among ties. A phrase is dropped if a longer candidate around it is met at least
    ``percent`` % as often. n counts all words of the language; n_before and n_after say how often a word
    stands before and after the phrase in its piece. Ties in the score go by a, then by the phrase's bytes.

    NULL languages are ``und``, as are rows that say so; NULL and empty texts have no words. Repeated rows
    count each. An empty table gives no rows. Only the two columns named are read.

    A shard is a task's own; one word, phrase or language may hold any share of the rows. The texts are
    read once and never shuffled. ``least`` decides what is sent as text, so a phrase under it has no count.
    """
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    shards = stage(_shards(rows, most_words, shard_bytes), "phrase_shards", n=F.sum("n_words"))
    sizes = shards.table.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("z")).groupBy(F.col("z.langs").alias("lang")).agg(F.sum("z.lang_words").alias("n"))
    found = stage(_frequent(shards.table, shards.measured["n"] or 0, most_words, least), "phrases").table

    size = F.size("words")
    candidates = found.where(size > 1)
    cut = candidates.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    parts = cut.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))})
    firsts = found.select("lang", F.col("words").alias("left"), F.col("a").alias("l"))
    seconds = found.select("lang", F.col("words").alias("right"), F.col("a").alias("r"))
    # 38 digits hold 10^6 a a for a up to 10^15.
    score = F.expr("CAST(1000000 AS DECIMAL(7, 0)) * CAST(CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0)) AS DECIMAL(30, 0)) div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))")
    scored = parts.join(firsts, ["lang", "left"]).join(seconds, ["lang", "right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where(size > 2).select("lang", "a", F.explode(_inside("words")).alias("words"))
    covered = inner.groupBy("lang", "words").agg(F.max("a").alias("longer"))
    kept = candidates.join(covered, ["lang", "words"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")
    phrases = kept.join(lowest, ["lang", "words"]).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"), "n_before", "n_after"
    )
    # First in some parts of a language, so that few rows are left for the task that ranks it.
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parted = phrases.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(8)))
    leading = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*by))).where(F.col("rank") <= top)
    best = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "n_before", "n_after")


def _inside(words: str):
    """All runs of at least two words that are shorter than the phrase."""
    return F.expr(
        f"flatten(transform(sequence(2, size({words}) - 1), k -> transform(sequence(1, size({words}) - k + 1), i -> slice({words}, i, k))))"
    )
