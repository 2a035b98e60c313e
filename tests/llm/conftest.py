import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, source string, n long, k long, shard int, size long"


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with NULLs, empty and long texts, ties, copies, near copies, repeated rows and clashing columns."""
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gämma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "l", "mu,", "NU!", "xi"]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    shared = [line(12) for _ in range(6)]
    texts = [None, "", " ", "\n", "\n\n \t\n", "one", "One two", "short\nshort", "token: abcdef1 AKIA" + "A1B2" * 5 + " " + "0af9" * 8]
    for i in range(60):
        lines = [rng.choice(shared) if rng.random() < 0.3 else line(rng.randint(1, 30)) for _ in range(rng.randint(1, 6))]
        lines = [rng.choice([x, f"  {x.upper()}\t", x]) for x in lines]
        texts.append("\n".join(lines))
    base = texts[20].split(" ")
    for i in range(12):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        texts.append(" ".join(copy))
    texts += [texts[30], texts[30], "ab" * 500, "ab" * 333 + "c", line(4000), "😀" * 300 + " secret='" + "x" * 9 + "' é" * 3, "l l l l l " * 60]
    rows = [(i, t, rng.choice(["src0", "src0", "src1", "src2", None]), 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[25], rows[25], (None, texts[26], "src9", 0, 0, 0, 0), (None, None, None, None, None, None, None), (None, texts[26], None, 5, 5, 5, 5)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
