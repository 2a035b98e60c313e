"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid end to end as linked symbols. An index maps every mergeable pair
to all its positions. The ranks that occur are applied in ascending order, each to all its positions at
once, and the lists of the pairs that a merge makes are extended; positions that a merge has overtaken
are told by their pair, which is then another one. Every text is read whole.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import frugal

#: Words whose codes a task keeps from batch to batch; beyond it forgets them and starts anew.
KEPT_WORDS = 250_000
#: Words encoded together.
INDEXED_WORDS = 50_000
BATCH_BYTES = 2 << 20
_SIGMA = "Σ"
# White space as the tokenizer's patterns take it.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """A word-end BPE model, with the steps before it. Workers keep it, so merges are numbers: left, right and made symbol by rank."""

    ids: dict[str, int]
    end: str
    merges: np.ndarray
    added: list[dict]
    pre_tokenizer: dict

    @cached_property
    def tokens(self) -> list[str]:
        """Tokens by id; added ones included."""
        known = {i: token for token, i in self.ids.items()} | {entry["id"]: entry["content"] for entry in self.added}
        return [known.get(i, "") for i in range(max(known) + 1)]

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pair keys (left << 32 | right), and the rank of each."""
        keys = self.merges[:, 0] << 32 | self.merges[:, 1]
        order = np.argsort(keys, kind="stable")
        return keys[order], order

    @cached_property
    def token_array(self) -> pa.Array:
        return pa.array(self.tokens, pa.string())

    @cached_property
    def first_symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each byte inside a word, and at its end."""
        symbols = byte_symbols()
        return tuple(np.array([self.ids[s + suffix] for s in symbols], np.int64) for suffix in ("", self.end))

    @cached_property
    def special(self) -> regex.Pattern | None:
        contents = sorted((entry["content"] for entry in self.added), key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, contents)) + ")") if contents else None

    @cached_property
    def words(self) -> regex.Pattern:
        """The pattern whose matches are the words."""
        split = next(step for step in self.pre_tokenizer["pretokenizers"] if step["type"] == "Split")
        return regex.compile(split["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACE}"))

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text, and whether a part is a special token."""
        if self.special is None or not self.special.search(text):
            yield text, False
            return
        for i, part in enumerate(self.special.split(text)):
            if part:
                yield part, i % 2 == 1

    def split(self, text: str) -> list[str]:
        """Words of a part without special tokens: composed, lowered character by character, then cut."""
        text = unicodedata.normalize("NFC", text)
        if _SIGMA in text:  # str.lower looks at a sigma's neighbours
            return self.words.findall(text.replace(_SIGMA, "σ").lower())
        return self.words.findall(text.lower())


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, steps = data["model"], data["normalizer"]["normalizers"]
    if model["type"] != "BPE" or model.get("byte_fallback") or [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: not a lower-case word BPE")
    if data.get("decoder"):
        raise ValueError(f"{path}: has a decoder")
    ids, pairs = model["vocab"], (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merges = np.array([(ids[left], ids[right], ids[left + right]) for left, right in pairs], np.int64).reshape(-1, 3)
    return Vocabulary(ids, model["end_of_word_suffix"] or "", merges, data["added_tokens"], data["pre_tokenizer"])


class _Numbers(dict):
    """Numbers words as they are first asked for, and lists those whose codes are not known yet."""

    def __init__(self):
        super().__init__()
        self.pending: list = []

    def __missing__(self, word):
        self.pending.append(word)
        self[word] = number = len(self)
        return number


class Codes:
    """Codes of the words seen so far: a word's number, and where its codes stand in one flat array.

    Special tokens are numbered as tuples, so that no word of a text can equal one.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.added = {entry["content"]: entry["id"] for entry in vocabulary.added}
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.starts, self.lengths = (np.zeros(0, np.int32) for _ in range(3))

    def words(self, text: str) -> np.ndarray:
        """Numbers of a text's words."""
        parts = []
        for part, is_special in self.vocabulary.pieces(text):
            words = [(part,)] if is_special else self.vocabulary.split(part)
            parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])

    def learn(self) -> None:
        """Codes of the words numbered since the last time."""
        flats, counts, pending = [self.flat], [self.lengths], self.numbers.pending
        for i in range(0, len(pending), INDEXED_WORDS):
            some = pending[i : i + INDEXED_WORDS]
            flat, lengths = encode_words(self.vocabulary, [w if isinstance(w, str) else "!" for w in some])
            special = [j for j, w in enumerate(some) if not isinstance(w, str)]  # "!" has one code, as they have
            flat[(np.cumsum(lengths) - 1)[special]] = [self.added[some[j][0]] for j in special]
            flats.append(flat)
            counts.append(lengths)
        self.numbers.pending = []
        self.flat, self.lengths = np.concatenate(flats), np.concatenate(counts)
        self.starts = np.cumsum(self.lengths) - self.lengths


@lru_cache(maxsize=2)
def _codes(path: str) -> Codes:
    return Codes(load(path))


def encode_words(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of distinct words by the pair occurrence index, end to end, and how many each has."""
    parts = [word.encode() for word in words]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum(lengths)
    inner, last = vocabulary.first_symbols
    symbol = inner[data]
    symbol[ends - 1] = last[data[ends - 1]]
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = -1
    before[ends - lengths] = -1
    alive = np.ones(n, bool)
    keys, ranks = vocabulary.pairs
    lefts, rights, merged = vocabulary.merges.T
    lists: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def rank_at(positions: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position, -1 without one."""
        right = after[positions]
        wanted = np.where(right >= 0, symbol[positions] << 32 | symbol[right], -1)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, ranks[place], -1)

    def enter(positions: np.ndarray) -> None:
        found = rank_at(positions)
        positions, found = positions[found >= 0], found[found >= 0]
        if not len(found):
            return
        order = np.argsort(found, kind="stable")
        positions, found = positions[order], found[order]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for rank, part in zip(found[np.append(0, cuts)].tolist(), np.split(positions, cuts)):
            if rank in lists:
                lists[rank].append(part)
            else:
                lists[rank] = [part]
                heapq.heappush(active, rank)

    enter(np.flatnonzero(after >= 0))
    while active:
        rank = heapq.heappop(active)
        found = lists.pop(rank)
        positions = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        positions = positions[alive[positions]]
        positions = positions[rank_at(positions) == rank]
        if not len(positions):
            continue
        if lefts[rank] == rights[rank]:
            positions = _apart(np.sort(positions), after)
        gone = after[positions]
        symbol[positions] = merged[rank]
        alive[gone] = False
        follow = after[gone]
        after[positions] = follow
        inside = follow >= 0
        before[follow[inside]] = positions[inside]
        previous = before[positions]
        enter(np.concatenate([previous[previous >= 0], positions[inside]]))

    return symbol[alive].astype(np.int32), np.add.reduceat(alive, ends - lengths, dtype=np.int32)


def _apart(positions: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions in order, those that no earlier kept one overlaps (a pair of one symbol twice)."""
    kept, gone = [], -1
    for position, right in zip(positions.tolist(), after[positions].tolist()):
        if position != gone:
            kept.append(position)
            gone = right
    return np.array(kept, np.int64)


def encode_texts(path: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts end to end, and where each text's begin; NULL and empty texts have none."""
    codes = _codes(path)
    if len(codes.numbers) > KEPT_WORDS:
        codes.forget()
    cut = [codes.words(text or "") for text in texts]
    codes.learn()
    counts = np.fromiter(map(len, cut), np.int64, len(cut))
    numbers = np.concatenate([np.zeros(0, np.int32), *cut])
    lengths = codes.lengths[numbers].astype(np.int64)
    ends = np.append(0, np.cumsum(lengths))
    at = np.repeat(codes.starts[numbers] - ends[:-1], lengths)
    at += np.arange(ends[-1])
    return codes.flat[at], ends[np.append(0, np.cumsum(counts))]


def decode_ids(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    """The tokens, special ones too, with a blank between; a vocabulary without a decoder joins them so."""
    return " ".join(map(vocabulary.tokens.__getitem__, ids))


def _decoded(vocabulary: Vocabulary, codes: pa.Array, cuts: pa.Array) -> pa.Array:
    """``decode_ids`` of each text's codes, without an object per code."""
    return pc.binary_join(pa.ListArray.from_arrays(cuts, vocabulary.token_array.take(codes)), " ")


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``most`` bytes together."""
    group = (np.cumsum(sizes) - sizes) // most if len(sizes) else sizes
    cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(sizes))
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(start, end - start)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs without ``text``, with its codes in the array ``ids`` and, if asked for, the codes decoded.

    NULL and empty texts have no codes and decode to an empty text. Nothing is shuffled. Columns of docs
    named like a new one are replaced.
    """
    new = [ids] if decoded is None else [ids, decoded]
    kept = [c for c in docs.columns if c not in (text, *new)]
    types = {ids: F.lit(None).cast("array<int>")} | ({decoded: F.lit("")} if decoded else {})
    schema = docs.select(*kept).limit(0).withColumns(types).schema

    def coded_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in _slices(batch, sizes, BATCH_BYTES):
            codes, cuts = map(pa.array, encode_texts(path, part.column(text).to_pylist()))
            cuts = cuts.cast(pa.int32())
            made: list[pa.Array] = [pa.ListArray.from_arrays(cuts, codes)]
            if decoded:
                made.append(_decoded(load(path), codes, cuts))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], names=[*kept, *new])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                yield from coded_batch(batch)
                del batch  # before the next one comes
        finally:
            _codes.cache_clear()  # a worker outlives its tasks; the next stage needs no codes

    return docs.select(*kept, text).mapInArrow(frugal(coded), schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """rows with column ``text``, the codes in ``ids`` decoded; NULL for NULL."""
    kept = [c for c in rows.columns if c != text]
    schema = rows.select(*kept).limit(0).withColumn(text, F.lit(None).cast("string")).schema

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)
        for batch in batches:
            texts = [None if c is None else decode_ids(vocabulary, c) for c in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], names=[*kept, text])

    return rows.select(*kept).mapInArrow(frugal(decoded), schema)
