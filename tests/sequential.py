"""Plain sequential Python versions of the results, for comparison on small inputs only."""

import re

ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
SPACE = frozenset(" \t\n\v\f\r")
SWITCHES = {"b": "B", "strong": "B", "i": "I", "em": "I", "title": "T", "script": "S"} | {
    f"h{level}": "H" for level in "123456"
}


def contexts(html):
    """[(word, context letters)] of an HTML body, character by character."""
    on, found, word = set(), [], ""
    tag = None  # text since the last '<' while inside a tag
    last_tag = ""
    for char in html + "\0":
        if char in ALNUM and tag is None and "S" not in on:
            word += char
            continue
        if word:
            found.append((word.lower(), "".join(c for c in "BHIT" if c in on) or "P"))
            word = ""
        if char == "<":
            tag = ""
        elif char == ">":
            last_tag = last_tag if tag is None else tag
            _switch(on, last_tag + " ")
            tag = None
        elif tag is not None:
            tag += char
    return found


def _switch(on, tag):
    closing, name = tag.startswith("/"), tag.removeprefix("/")
    end = next(i for i, char in enumerate(name) if char in SPACE)
    switch = SWITCHES.get(name[:end].lower()) if name[:end].isascii() else None
    if switch:
        (on.discard if closing else on.add)(switch)


def words(text):
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]


def build(pages):
    """(url map, lexicon, postings, visit lists) of [(url, html or None)]; None is a page that is not indexed."""
    urls, lexicon, counts, visits = {}, {}, {}, {}
    for url, html in pages:
        doc = urls.setdefault(url, len(urls))
        if html is None:
            continue
        for word in words(url) + [w for w, _ in contexts(html)]:
            word_id = lexicon.setdefault(word, len(lexicon))
            counts[word_id, doc] = counts.get((word_id, doc), 0) + 1
            visited = visits.setdefault(word_id, [])
            if visited and visited[-1][0] == doc:
                visited[-1][1] += 1
            else:
                visited.append([doc, 1])
    return urls, lexicon, counts, visits
