"""Plain Python versions of the operators, for small inputs only."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = "\x20\t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs):
    """{(doc_id, text): (n_lines, n_dropped, kept)}; None ids are one document after all others."""
    order = lambda d: (d is None, d or 0)
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[line.strip(SPACE).translate(LOWER)].add(doc_id)
    found = {}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(SPACE).translate(LOWER)
            if len(key) < 10 or len(holders[key]) < 2 or min(holders[key], key=order) == doc_id:
                kept.append(line)
        found[doc_id, text] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return found


def components(docs, k, percent):
    """{position: (set size, smallest linked doc_id, number of links)} of [(doc_id, text)]."""
    sets = []
    for _, text in docs:
        w = words((text or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            r = find(i)
            least[r] = min(least.get(r, doc_id), doc_id)
    return {i: (len(sets[i]), least.get(find(i)), links[i]) for i in range(len(docs))}


def quality(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


SECRETS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def secrets(text):
    return sorted(
        (m.start(), i, m.end(), kind)
        for i, (kind, (pattern, group, least)) in enumerate(SECRETS.items())
        for m in re.finditer(pattern, text or "", re.ASCII)
        if len(m.group(group)) >= least
    )


def passages(texts, length):
    """[(n_removed, n_spans, kept)]"""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        found.append((sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return found
