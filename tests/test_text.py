import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions import markup, text
from wordloom.operators import tokens

from sequential import contexts

BODIES = [
    ("a <b>B c</b> <br>d <em>e<script>if(a<b && c>d) x('</p>')</script> f</em> \u212a x < y <script >q</script > z",
     "a/P b/B c/B d/P e/I f/BI x/B z/B"),
    ("a <b>B c</b> <br>d <em>e<script>if(a<b && c>d) x('</p>')</script> f</em> K x < y <script >q</script > z",
     "a/P b/B c/B d/P e/I f/BI k/B x/B z/B"),
    ("t <H1 id=x>u <strong>v</H1>w</strong> <!-- c > d --> māori &nbsp; <scripty>k</scripty> <script>un<b >closed",
     "t/P u/H v/BH w/B d/P m/P ori/P nbsp/P k/P"),
    ("p <script src=1><i>q</i></SCRIPT\n> r <title>s</title", "p/P r/P s/T"),
    ("a > b <x <script> g </script> h", "a/P b/P h/P"),
    ("<script a<b> j </script> k <> l </> m", "j/B k/B l/B m/B"),
    ("<b><b>x</b>y</b>z", "x/B y/P z/P"),
    ("<h1>a</h2>b<h3 >c", "a/H b/P c/H"),
    ("<br>p<bold>q<B\n>r</STRONG>s", "p/P q/P r/B s/P"),
    ("<!-- <b>no--> yes", "no/B yes/B"),
    ("<style>p{c:1}</style>&amp; café \u212aey", "p/P c/P 1/P amp/P caf/P ey/P"),
    ("<scripty>k</scripty><script >u", "k/P"),
    ("no tags at all", "no/P tags/P at/P all/P"),
    ("<>a<  b>c", "a/P c/P"),
    ("x <i>y</em>z <title>t</title>u", "x/P y/I z/P t/T u/P"),
    ("", ""),
    ("<" * 50 + "a" + ">" * 50 + "b", "b/P"),
    ("x\u017fy <\u017fcript>w</\u017fcript>", "x/P y/P w/P"),
]


def _bodies(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "seq BIGINT, body STRING")


def _html_words(spark, bodies):
    rows = _bodies(spark, bodies).select("seq", text.html_words("body").alias("w")).collect()
    return {row.seq: row.w for row in rows}


def _body_contexts(spark, bodies):
    pages = spark.createDataFrame(
        [(i, 0, "", "HTTP/1.1 200 OK\r\n\r\n" + body) for i, body in enumerate(bodies)],
        "seq BIGINT, file_no BIGINT, url STRING, doc STRING",
    )
    found = {i: {} for i in range(len(bodies))}
    for row in tokens.word_contexts(pages).collect():
        found[row.seq][row.word, row.ctx] = row.n
    return found


def _counted(pairs):
    return {pair: pairs.count(pair) for pair in pairs}


@pytest.mark.parametrize("body, expected", BODIES)
def test_sequential_version_agrees_with_the_expected_words(body, expected):
    assert [f"{w}/{c}" for w, c in contexts(body)] == expected.split()


def test_words_of_hand_made_bodies(spark):
    found = _html_words(spark, [body for body, _ in BODIES])
    for i, (_, expected) in enumerate(BODIES):
        assert found[i] == [pair.split("/")[0] for pair in expected.split()]


def test_contexts_of_hand_made_bodies(spark):
    found = _body_contexts(spark, [body for body, _ in BODIES])
    for i, (body, expected) in enumerate(BODIES):
        assert found[i] == _counted([tuple(pair.split("/")) for pair in expected.split()]), body


PIECES = st.lists(
    st.sampled_from([
        "<", ">", "</", "<b>", "</b>", "<B ", "<script>", "</script>", "<SCRIPT x>", "</script\n>", "<h1>", "</h6>",
        "<i>", "</em>", "<title>", "</title >", "<br>", "<scripty>", "a", "Bc", "9", " ", "\n", "ā", "\u212a",
        "/", "&amp;", "script", "b", "h2",
    ]),
    max_size=25,
).map("".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES, min_size=60, max_size=120))
def test_random_bodies_agree_with_the_sequential_version(spark, bodies):
    found_words, found_contexts = _html_words(spark, bodies), _body_contexts(spark, bodies)
    for i, body in enumerate(bodies):
        expected = contexts(body)
        assert found_words[i] == [word for word, _ in expected], body
        assert found_contexts[i] == _counted(expected), body


def test_large_adversarial_bodies(spark):
    bodies = [
        "<script>" + "a<b>c " * 300_000 + "</script> end",
        "start <script>" + "x " * 1_000_000,
        "start <div " + "y " * 1_000_000,
        "<script>" * 300_000 + " z",
        "<" * 1_000_000 + " z",
        "w " * 500_000,
    ]
    rows = _bodies(spark, bodies).select("seq", F.size(text.html_words("body")).alias("n")).collect()
    assert [row.n for row in sorted(rows)] == [1, 1, 1, 0, 0, 500_000]


def test_url_words(spark):
    row = spark.createDataFrame([("HTTP://A-b.Co.nz/x_Y?q=1%20āz#T",)], "url STRING").select(text.words("url")).first()
    assert row[0] == ["http", "a", "b", "co", "nz", "x", "y", "q", "1", "20", "z", "t"]


def test_text_ends_at_nul(spark):
    row = spark.createDataFrame([("ab\0cd",), ("ab",)], "t STRING").select(text.until_nul("t").alias("t")).collect()
    assert [r.t for r in row] == ["ab", "ab"]


_NAMES = {"b": 1, "strong": 1, "h1": 2, "h6": 2, "i": 4, "em": 4, "title": 8, "script": 16}


def _tagged(n):
    rng = random.Random(n)
    tags = [rng.choice(["", "/"]) + rng.choice(list(_NAMES)) for _ in range(n)]
    return ["word"] + [tag + rng.choice(["> word", " x> word", ">"]) for tag in tags]


def _states(pieces):
    state, found = 0, []
    for i, piece in enumerate(pieces):
        tag = piece.split(">")[0].split(" ")[0]
        bit = _NAMES[tag.lstrip("/")] if i else 0
        state = state & ~bit if tag.startswith("/") else state | bit
        found.append(state)
    return found


def test_states_are_carried_over_blocks(spark):
    block = markup.SCAN_BLOCK
    pages = [_tagged(n) for n in (0, 1, 7, block - 2, block - 1, block, block + 1, 5 * block + 3)]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, pieces array<string>")
    found = {r.i: r.states for r in rows.select("i", markup.piece_states(F.col("pieces")).alias("states")).collect()}
    assert found == {i: _states(page) for i, page in enumerate(pages)}


def test_states_take_time_in_proportion_to_the_tags(spark):
    taken = []
    for n in (8_000, 64_000):
        rows = spark.createDataFrame([(_tagged(n),)], "pieces array<string>").cache()
        rows.count()
        states = rows.select(F.aggregate(markup.piece_states(F.col("pieces")), F.lit(0), lambda a, b: a + b))
        states.collect()
        began = time.monotonic()
        states.collect()
        taken.append(time.monotonic() - began)
    assert taken[1] < 8 * taken[0] + 2  # the square would be 64 times
