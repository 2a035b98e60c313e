"""Removal of repeated passages by a distributed merge sort of suffixes.

A passage of LENGTH bytes that occurs twice is found through anchors: the GRAM-byte piece of smallest
hash inside every window of LENGTH bytes, the first one if several tie. Equal windows have equal
anchors, so only suffixes at anchors are sorted, and of those only the ones whose piece is met again.
A run sorts its suffixes and sends them front-coded, each distinct one once. Loser trees merge the runs;
they carry the common prefixes along and never compare a byte again that is known to be equal. What
stands to the left of an anchor is then compared by classes, so no pair of suffixes is ever formed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import Chunk, chunks, frugal, mixed, powers, prefix_hashes
from wordloom.plans.stages import stage

LENGTH = 200
GRAM = 50
#: Bytes of text in a run, suffixes in a merge, on average.
RUN_BYTES = 16 << 20
MERGE_ITEMS = 1 << 15
#: Suffixes with one piece beyond which they are dealt out by what stands around it.
HOT_ITEMS = 1 << 16
_STEP = 8
_U = np.uint64
ANCHORS = "h long, at long, k long, run long, pos int, low short, high short"
BLOCKS = "bucket long, run long, data binary"
RANGES = "run long, item long, low short, high short"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   run_bytes: int = RUN_BYTES, merge_items: int = MERGE_ITEMS, hot_items: int = HOT_ITEMS) -> DataFrame:
    """KEPT of every row: its bytes less those covered by a ``length``-byte string that also starts elsewhere.

    Strings are judged on the input; ``kept`` is binary, as a cut may fall inside a character. NULL texts
    are empty; texts under ``length`` bytes lose nothing unless they cannot: they hold no such string.
    Rows that repeat a text lose all of it from ``length`` bytes on; NULL ids are kept. An empty table
    gives an empty result. Texts are told apart by 64 bits of their content.

    Text is shuffled once, by runs that mix all rows, copies too; the plan uses that exchange twice. A piece
    that very many suffixes share is dealt out by the bytes around it, in steps of the window's place.
    """
    gram = min(GRAM, max(1, length // 4))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("data")).withColumn(
        "k", F.xxhash64("data")
    )
    sizes = rows.agg(F.sum(F.octet_length("data")).alias("bytes")).first()
    runs = max(1, -(-(sizes["bytes"] or 0) // run_bytes))
    placed = rows.withColumn("run", F.pmod(F.xxhash64("k", "doc_id"), F.lit(runs)))
    scanned = placed.where(F.octet_length("data") >= length).select("k", "run", "data").mapInArrow(frugal(_anchors(length, gram)), ANCHORS)
    anchors = stage(scanned, "passage_scan").table
    met = anchors.groupBy("h").agg(F.min("at").alias("_first"), F.max("at").alias("_last"), F.count("*").alias("_n")).where("_first < _last")
    again = stage(met.select("h", (F.col("_n") > hot_items).alias("hot")), "passage_pieces").table
    found = anchors.join(again, "h").groupBy("k", "pos").agg(
        F.min("run").alias("run"), F.max("low").alias("low"), F.max("high").alias("high"), F.max("hot").alias("hot")
    )
    candidates = stage(found, "passage_anchors", n=F.count("*"))
    keys = placed.where(F.octet_length("data") >= length).groupBy("k", "run").agg(F.count("*").alias("_n"))
    copied = keys.groupBy("k").agg(F.sum("_n").alias("_all")).where("_all > 1").select("k")
    copies = stage(keys.select("k", "run").join(copied, "k"), "passage_copies").table
    buckets = max(1, -(-candidates.measured["n"] // merge_items))

    none = F.lit(None)
    facts = candidates.table.select("run", "k", "pos", "low", "high", "hot", none.cast("long").alias("item")).unionByName(
        copies.select("run", "k", none.cast("int").alias("pos"), none.cast("short").alias("low"), none.cast("short").alias("high"),
                      F.lit(False).alias("hot"), none.cast("long").alias("item"))
    )
    texts = placed.select("run", "k", "doc_id", "data").groupBy("run")
    blocks = texts.cogroup(facts.groupBy("run")).applyInArrow(_runs(length, gram, buckets), BLOCKS)
    ranges = blocks.groupBy("bucket").applyInArrow(_merged(length), RANGES)
    answers = facts.unionByName(
        ranges.select("run", none.cast("long").alias("k"), none.cast("int").alias("pos"), "low", "high", F.lit(False).alias("hot"), "item")
    )
    return texts.cogroup(answers.groupBy("run")).applyInArrow(_cut(length, gram), KEPT)


# --- anchors ------------------------------------------------------------------------------------------


def _anchors(length: int, gram: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column("k").to_pylist()
            new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]  # copies in one task speak once
            some = batch.take(pa.array(new, pa.int64()))
            for chunk in chunks(some.column("data")):
                pos, h, low, high = anchors_of(chunk, length, gram)
                row = np.searchsorted(chunk.ends, pos)
                local = pos - chunk.starts[row]
                k = some.column("k").to_numpy()[row + chunk.first]
                at = mixed(k.view(_U) * _U(0xD6E8FEB86659FD93) + local.astype(_U))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)), pa.array(at.view(np.int64)), pa.array(k),
                        some.column("run").take(pa.array(row + chunk.first)), pa.array(local.astype(np.int32)),
                        pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)),
                    ],
                    names=["h", "at", "k", "run", "pos", "low", "high"],
                )

    return found


def anchors_of(chunk: Chunk, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place in the chunk, hash of the piece, least and largest distance to the start of its windows)."""
    data, width = chunk.data, length - gram + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = prefix_hashes(data)
    h = mixed((sums[gram:] - sums[:-gram]) * powers(len(data) + 1)[1][: len(data) - gram + 1])
    key = (h >> _U(32) << _U(32)) | np.arange(len(h), dtype=_U)
    rows = np.append(key, np.full(-len(key) % width, ~_U(0))).reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - width + 1
    starts = np.arange(n)
    inside = starts + length <= chunk.ends[np.searchsorted(chunk.ends, starts)]
    starts = starts[inside]
    place = (np.minimum(after[:n], before[width - 1 : width - 1 + n])[inside] & _U(0xFFFFFFFF)).astype(np.int64)
    # Windows that follow each other in one text go to anchors that never step back.
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return at, h[at], at - starts[last] if len(at) else at, at - starts[first] if len(at) else at


# --- runs ---------------------------------------------------------------------------------------------


class Run:
    """The suffixes of one run: distinct (suffix, left part, low) in order, and the anchors that have each."""

    def __init__(self, texts: pa.Table, facts: pa.Table, length: int):
        self.length = length
        self.keys = texts.column("k").to_pylist()
        self.data = texts.column("data").to_pylist()
        row_of = {k: i for i, k in reversed(list(enumerate(self.keys)))}
        anchors = facts.filter(pc.is_valid(facts.column("pos")))
        items = []
        for k, pos, low, high, hot in zip(*(anchors.column(c).to_pylist() for c in ("k", "pos", "low", "high", "hot"))):
            row = row_of[k]
            text = self.data[row]
            for a, b in ([(low, high)] if not hot else _steps(low, high)):
                items.append((text[pos : pos + length - a], text[pos - b : pos], a, hot, row, pos))
        items.sort()
        self.suffixes, self.lefts, self.lows, self.hots, self.counts = [], [], [], [], []
        item_of, rows, places, last = [], [], [], None
        for suffix, left, low, hot, row, pos in items:
            if last != (suffix, left, low):
                last = (suffix, left, low)
                self.suffixes.append(suffix)
                self.lefts.append(left)
                self.lows.append(low)
                self.hots.append(hot)
                self.counts.append(0)
            self.counts[-1] += 1
            item_of.append(len(self.suffixes) - 1)
            rows.append(row)
            places.append(pos)
        self.item_of, self.rows, self.places = (np.array(x, np.int64) for x in (item_of, rows, places))


def _steps(low: int, high: int) -> list[tuple[int, int]]:
    """The distances cut at multiples of _STEP."""
    return [(max(low, d), min(high, d + _STEP - 1)) for d in range(low - low % _STEP, high + 1, _STEP)]


def _bucket(suffix: bytes, left: bytes, low: int, hot: bool, length: int, gram: int) -> int:
    """Equal windows get equal numbers: by the piece, or by all that the windows of a step have in common."""
    if not hot:
        return zlib.crc32(suffix[:gram])
    step = low - low % _STEP
    return zlib.crc32(left[len(left) - step :], zlib.crc32(suffix[: length - step - _STEP + 1], step + 1))


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need not be looked at."""
    n = min(len(a), len(b)) - known
    if n <= 0:
        return known
    differ = int.from_bytes(a[known : known + n]) ^ int.from_bytes(b[known : known + n])
    return known + (8 * n - differ.bit_length()) // 8


def _runs(length: int, gram: int, buckets: int):
    def made(texts: pa.Table, facts: pa.Table) -> pa.Table:
        names, out = ["bucket", "run", "data"], ([], [], [])
        run = Run(texts, facts, length)
        number = texts.column("run")[0].as_py() if len(texts) else None
        by_bucket: dict[int, list[int]] = {}
        for i, item in enumerate(zip(run.suffixes, run.lefts, run.lows, run.hots)):
            by_bucket.setdefault(_bucket(*item, length, gram) % buckets, []).append(i)
        for bucket, items in by_bucket.items():
            out[0].append(bucket)
            out[1].append(number)
            out[2].append(_front_coded(run, items))
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=names)

    return made


def _front_coded(run: Run, items: list[int]) -> bytes:
    """Per item: its number, what it shares with the suffix before, low, the length of its left part, whether it repeats."""
    shared, previous, parts = [], b"", []
    for i in items:
        suffix = run.suffixes[i]
        shared.append(common_prefix(previous, suffix) if parts else 0)
        parts.append(suffix[shared[-1] :])
        previous = suffix
    head = np.array([items, shared, [run.lows[i] for i in items], [len(run.lefts[i]) for i in items], [run.counts[i] > 1 for i in items]], np.int32)
    body = head.tobytes() + b"".join(parts) + b"".join(run.lefts[i] for i in items)
    return len(items).to_bytes(4, "little") + len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _opened(data: bytes, length: int) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    n, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:12], "little")
    body = pa.decompress(data[12:], size, codec="zstd", asbytes=True)
    head = np.frombuffer(body, np.int32, 5 * n).reshape(5, n)
    at, previous, suffixes, lefts = 20 * n, b"", [], []
    for shared, low in zip(head[1].tolist(), head[2].tolist()):
        end = at + length - low - shared
        previous = previous[:shared] + body[at:end]
        suffixes.append(previous)
        at = end
    for size in head[3].tolist():
        lefts.append(body[at : at + size])
        at += size
    return head, suffixes, lefts


# --- merge --------------------------------------------------------------------------------------------


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, item, bytes shared with the item before) of sorted runs with their own shared lengths, in order.

    A loser tree: every loser knows how much it shares with the winner that beat it. Of two that share
    different lengths with the last winner the longer comes first, without a look at the bytes; equal ones are
    compared behind what they share.
    """
    k = 1
    while k < len(runs):
        k *= 2
    strings, shares = [r[0] for r in runs], [r[1] for r in runs]
    cursor, known = [0] * len(runs), [0] * len(runs)
    losers = [-1] * k

    def beats(a: int, b: int) -> bool:
        """Whether run a comes before b; the loser's shared length becomes that with the winner."""
        if b < 0 or cursor[b] >= len(strings[b]):
            return True
        if a < 0 or cursor[a] >= len(strings[a]):
            return False
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = strings[a][cursor[a]], strings[b][cursor[b]]
        h = common_prefix(x, y, known[a])
        first = x[h : h + 1] < y[h : h + 1] or (h == len(x) == len(y) and a < b)
        known[b if first else a] = h
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k if node - k < len(runs) else -1
        a, b = build(2 * node), build(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    winner = build(1)
    while winner >= 0 and cursor[winner] < len(strings[winner]):
        yield winner, cursor[winner], known[winner]
        cursor[winner] += 1
        if cursor[winner] < len(strings[winner]):
            known[winner] = shares[winner][cursor[winner]]
        node = (winner + k) // 2
        while node:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2


def _merged(length: int):
    def made(blocks: pa.Table) -> pa.Table:
        opened = [_opened(data, length) for data in blocks.column("data").to_pylist()]
        numbers = blocks.column("run").to_pylist()
        order = list(merge([(suffixes, head[1].tolist()) for head, suffixes, _ in opened]))
        source, item, shared = (np.array(x, np.int64) for x in zip(*order))
        lefts = [opened[r][2][i][::-1] for r, i, _ in order]
        lows = np.array([opened[r][0][2][i] for r, i, _ in order])
        repeats = np.array([opened[r][0][4][i] for r, i, _ in order], bool)
        names = np.array([opened[r][0][0][i] for r, i, _ in order], np.int64)
        at, low, high = matched(shared, lefts, lows, repeats, length)
        return pa.Table.from_arrays(
            [pa.array(np.array(numbers, np.int64)[source[at]]), pa.array(names[at]), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16))],
            names=["run", "item", "low", "high"],
        )

    return made


def matched(shared: np.ndarray, lefts: list[bytes], lows: np.ndarray, repeats: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(item, low, high): ranges of distances at which an item's window is another one's too.

    Items stand in the order of their suffixes. A window at distance d has d bytes to the left and
    length - d of the suffix; both sides fall into classes that neighbours in order share, and two windows are
    equal if both classes are.
    """
    n = len(lefts)
    highs = np.array([len(left) for left in lefts])
    by_left = np.array(sorted(range(n), key=lefts.__getitem__), np.int64)
    left_shared = np.zeros(n, np.int64)
    for i in range(1, n):
        left_shared[i] = common_prefix(lefts[by_left[i - 1]], lefts[by_left[i]])
    weights = np.where(repeats, 2, 1)
    state, begun = np.zeros(n, bool), np.zeros(n, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    left_class = np.zeros(n, np.int64)
    for d in range(int(highs.max(initial=0)) + 2):
        now = np.zeros(n, bool)
        active = np.flatnonzero((lows <= d) & (highs >= d))
        if len(active):
            right_class = np.cumsum(shared < length - d)
            left_class[by_left] = np.cumsum(left_shared < d)
            _, classes = np.unique(right_class[active] * (n + 1) + left_class[active], return_inverse=True)
            now[active] = np.bincount(classes, weights[active])[classes] > 1
        ended = np.flatnonzero(state & ~now)
        found.append((ended, begun[ended], np.full(len(ended), d - 1)))
        begun[now & ~state] = d
        state = now
    return tuple(np.concatenate(x) for x in zip(*found))


# --- what is kept -------------------------------------------------------------------------------------


def _cut(length: int, gram: int):
    def made(texts: pa.Table, answers: pa.Table) -> pa.Table:
        is_range = pc.is_valid(answers.column("item"))
        facts, ranges = answers.filter(pc.invert(is_range)), answers.filter(is_range)
        run = Run(texts, facts, length)
        copied = set(facts.filter(pc.is_null(facts.column("pos"))).column("k").to_pylist())
        item, low, high = (ranges.column(c).to_numpy().astype(np.int64) for c in ("item", "low", "high"))
        first, after = np.searchsorted(run.item_of, item), np.searchsorted(run.item_of, item, side="right")
        each = np.repeat(np.arange(len(item)), after - first)
        at = np.arange(len(each)) - np.repeat(np.cumsum(after - first) - (after - first), after - first) + first[each]
        rows, starts, ends = run.rows[at], run.places[at] - high[each], run.places[at] - low[each] + length
        order = np.lexsort((starts, rows))
        rows, starts, ends = rows[order], starts[order], ends[order]
        cuts = np.searchsorted(rows, np.arange(len(run.data) + 1)).tolist()
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept")}
        for i, data in enumerate(run.data):
            spans = [(0, len(data))] if run.keys[i] in copied else joined(starts[cuts[i] : cuts[i + 1]].tolist(), ends[cuts[i] : cuts[i + 1]].tolist())
            kept, at_byte = [], 0
            for start, end in spans:
                kept.append(data[at_byte:start])
                at_byte = end
            kept.append(data[at_byte:])
            kept = b"".join(kept)
            for c, value in (("n_bytes", len(data)), ("n_removed", len(data) - len(kept)), ("n_spans", len(spans)), ("kept", kept)):
                out[c].append(value)
        return pa.Table.from_arrays(
            [texts.column("doc_id"), *[pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")], pa.array(out["kept"], pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return made


def joined(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Union of spans sorted by start; spans that touch are one run of bytes."""
    spans: list[tuple[int, int]] = []
    for start, end in zip(starts, ends):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans
