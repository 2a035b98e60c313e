"""Words and shingles of whole texts as numpy arrays, for use inside tasks.

White space is ``[\x20\x09-\x0D]``, letters are lowered in A-Z only. Texts are taken in chunks of some
megabytes, so a task's memory follows the chunk or its longest text, never the number of texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, wraps

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between terms: all of ASCII but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


#: Options of the C library's malloc: blocks from this size on are mapped, and so given back when they are freed; of
#: the rest so much may stay at hand, as arrays that come and go for every text would cost more in mapping than in use.
_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1
_MAPPED_BYTES, _KEPT_BYTES = 4 << 20, 32 << 20


def _libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt, libc.malloc_trim  # noqa: B018  other C libraries lack them
    except (OSError, AttributeError):
        return None
    return libc


if (_LIBC := _libc()) is not None:
    # Workers stay alive between tasks and stages; what one stage has needed must not add to the next.
    _LIBC.mallopt(_MMAP_THRESHOLD, _MAPPED_BYTES)
    _LIBC.mallopt(_TRIM_THRESHOLD, _KEPT_BYTES)
    pa.set_memory_pool(pa.system_memory_pool())


def give_back() -> None:
    """Return freed memory to the system, and that of the powers, which the next task soon makes again."""
    _powers[:] = [np.ones(1, _U), np.ones(1, _U)]
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def frugal(function: Callable) -> Callable:
    """A task function over batches that gives its memory back when it ends."""

    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values with their bits spread (splitmix64's last steps)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, up to n - 1 at least; only those up to a chunk are kept."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    made = []
    for base in (_BASE, _BASE_INVERSE):
        factors = np.full(n, base, _U)
        factors[0] = 1
        made.append(np.cumprod(factors))
    if n <= 2 * CHUNK_BYTES:
        _powers[:] = made
    return made[0], made[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """sums with which ``span_hashes`` hashes any part of ``data`` in constant time."""
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(len(sums))[1][starts] + (ends - starts).astype(_U))


@dataclass
class Chunk:
    """Some texts end to end: rows first to last of the batch, their bytes, each text's start and end."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    apart: np.ndarray

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words."""
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[1:] = ~self.apart[self.data]
        steps = np.diff(inside, append=np.int8(0))
        return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)

    @cached_property
    def word_rows(self) -> np.ndarray:
        """Index of each text's first word, and the number of words at the end."""
        return np.append(np.searchsorted(self.spans[0], self.starts), len(self.spans[0]))

    @property
    def word_counts(self) -> np.ndarray:
        return np.diff(self.word_rows)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return span_hashes(prefix_hashes(self.data), *self.spans)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every run of k words inside a text; by its first word."""
        words, counts = self.word_hashes, self.word_counts
        n = max(0, len(words) - k + 1)
        found = np.zeros(n, _U)
        for j in range(k):
            found = mixed(found + words[j : j + n] * _U(2 * j + 1))
        row = np.repeat(np.arange(len(counts)), counts)
        inside = row[:n] == row[k - 1 : k - 1 + n]
        return np.where(inside, found, _U(0)), np.where(inside, row[:n], -1)


def chunks(
    column: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES, apart: np.ndarray = _SPACE
) -> Iterator[Chunk]:
    """The texts of a string column in order; NULL is an empty text. A line feed keeps texts apart.

    Words are what stands between bytes marked in ``apart``, which must mark the line feed.
    """
    texts = column.cast(pa.large_binary()).to_pylist()
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= chunk_bytes or i == len(texts) - 1:
            part = [t or b"" for t in texts[first : i + 1]]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            ends = np.cumsum(lengths + 1) - 1
            data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
            yield Chunk(first, i + 1, _LOWER[data] if lower else data, ends - lengths, ends, apart)
            first, held = i + 1, 0
