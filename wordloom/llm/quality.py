"""Quality rules as a ledger: every rule once, then any number of policies on its bits.

A ledger row holds the measurements of a text and one bit per rule that it fails. Policies are versioned
sets of rules. Verdicts and ablations read the bits alone, never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import Chunk, chunks, give_back

MEASURES = ["n_words", "word_chars", "n_symbols", "n_upper_words", "n_lines", "n_dup_lines", "n_repeat_words"]
REPEAT_WINDOW = 5

# The limits of the rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
MAX_UPPER_PERCENT = 60
MIN_MEAN_CHARS, MAX_MEAN_CHARS = 2, 15


@dataclass(frozen=True)
class Rule:
    """A rule's bit never changes; ``fails`` is a condition on the measurements."""

    bit: int
    name: str
    fails: str


RULES = [
    Rule(0, "too_few_words", f"n_words < {MIN_WORDS}"),
    Rule(1, "repeated_windows", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule(2, "symbols", f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words"),
    Rule(3, "duplicate_lines", f"100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines"),
    Rule(4, "shouting", f"100 * n_upper_words > {MAX_UPPER_PERCENT} * n_words"),
    Rule(5, "short_words", f"word_chars < {MIN_MEAN_CHARS} * n_words"),
    Rule(6, "long_words", f"word_chars > {MAX_MEAN_CHARS} * n_words"),
]


@dataclass(frozen=True)
class Policy:
    """A version of the rules that count."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << rule.bit for rule in RULES if rule.name in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
#: The rules of the word lengths stay out of it: text without blanks is not bad for that.
STANDARD = Policy("standard-1", (*BASE.rules, "symbols", "duplicate_lines", "shouting"))

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK = bytes([0x20, *range(0x09, 0x0E)])


def ledger(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The columns of ``docs`` but ``text``, the MEASURES, and ``failed``, a bit for each rule that fails.

    A NULL text has no words. Lines are split at line feeds; a line counts if it has a word. Nothing is
    shuffled. Columns of docs that are named like a measurement are replaced by it.
    """
    kept = [c for c in docs.columns if c not in [text, *MEASURES, "failed"]]
    found = docs.select(*kept, measurements(F.col(text)).alias("_found"))
    made = found.select(*kept, *[F.col(f"_found.{m}").alias(m) for m in MEASURES])
    return made.withColumn("failed", failed_bits(rules))


def measurements(text: Column) -> Column:
    """A struct of the MEASURES of each text. Only the text goes to Python, and only numbers come back."""

    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for batch in batches:
                parts = [measure(chunk) for chunk in chunks(batch)]
                columns = [np.concatenate([np.asarray(part[m], np.int64) for part in parts] or [np.zeros(0, np.int64)]) for m in MEASURES]
                yield pa.StructArray.from_arrays([pa.array(c) for c in columns], MEASURES)
        finally:
            give_back()

    return measured(text)


def failed_bits(rules: list[Rule] = RULES) -> Column:
    """A bit for each rule that the measurements in the row fail."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long") for rule in rules]
    failed = F.lit(0).cast("long")
    for bit in bits:
        failed = failed.bitwiseOR(bit)
    return failed


def passes(policy: Policy, failed: Column | str = "failed") -> Column:
    """Whether no rule of the policy fails."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """(version, rule, n_failed, n_only): how many rows fail a rule, and how many would pass without it.

    Rows are first counted by their bits, of which there are few, so each task sends some counts only.
    """
    by_bits = rows.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    named = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in policy.rules
    ])
    each = by_bits.select("bits", "n", F.explode(named).alias("r"))
    return each.groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n"))), F.lit(0)).cast("long").alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).cast("long").alias("n_only"),
    )


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    data, first = chunk.data, chunk.word_rows
    starts, ends = chunk.spans
    counts = chunk.word_counts
    heads = ((data & 0xC0) != 0x80) & ~_SPACE[data]
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    sums = {name: _sums(flags) for name, flags in (("upper", upper), ("lower", lower))}
    shouted = (sums["upper"][ends] - sums["upper"][starts] >= 2) & (sums["lower"][ends] == sums["lower"][starts])
    per_text = lambda flags: (s := _sums(flags))[chunk.ends] - s[chunk.starts]
    lines, duplicates = _lines(chunk)
    return {
        "n_words": counts,
        "word_chars": per_text(heads),
        "n_symbols": per_text(_SYMBOL[data]),
        "n_upper_words": (s := _sums(shouted))[first[1:]] - s[first[:-1]],
        "n_lines": lines,
        "n_dup_lines": duplicates,
        "n_repeat_words": _repeat_words(chunk),
    }


def _sums(flags: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums


def _lines(chunk: Chunk) -> tuple[list[int], list[int]]:
    """Lines with a word, and those of them that equal an earlier one of their text."""
    data = chunk.data.tobytes()
    lines, duplicates = [], []
    for start, end in zip(chunk.starts.tolist(), chunk.ends.tolist()):
        found = [line for line in data[start:end].split(b"\n") if line.strip(_BLANK)]
        lines.append(len(found))
        duplicates.append(len(found) - len(set(found)))
    return lines, duplicates


def _repeat_words(chunk: Chunk) -> np.ndarray:
    """Words inside a window of REPEAT_WINDOW words that its text holds at least twice."""
    hashes, row = chunk.shingles(REPEAT_WINDOW)
    at = np.flatnonzero(row >= 0)
    order = at[np.lexsort((hashes[at], row[at]))]
    same = np.zeros(len(order) + 1, bool)
    if len(order) > 1:
        same[1:-1] = (hashes[order[1:]] == hashes[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    twice = order[same[:-1] | same[1:]]
    steps = np.zeros(len(chunk.spans[0]) + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + REPEAT_WINDOW, -1)
    covered = _sums(np.cumsum(steps[:-1]) > 0)
    return covered[chunk.word_rows[1:]] - covered[chunk.word_rows[:-1]]
