from wordloom.functions import http
from wordloom.operators.tokens import ok_pages

# response, status, is it indexed, body
RESPONSES = [
    ("HTTP/1.1 200 OK\r\nA: b\r\n\r\nx", 200, True, "x"),
    ("http/1.0 200 OK\r\n\r\nx", 200, True, "x"),
    ("HTTP/1.1   200\r\n\r\nx", 200, True, "x"),
    ("HTTP/1.1 200x\r\n\r\nx", 200, True, "x"),
    ("HTTP/1.1 +200\r\n\r\nx", 200, True, "x"),
    ("HTTP/1.1 -200\r\n\r\nx", -200, False, "x"),
    ("HTTP/1.1 404 Not Found\r\n\r\nx", 404, False, "x"),
    ("HTTP/1.1 OK\r\n\r\nx", None, False, "x"),
    ("HTTP/1.1 99999999999 OK\r\n\r\nx", None, False, "x"),
    ("HTTP/1.1 200 OK\nA: b\n\nx", 200, False, None),
    ("<html>x", None, False, None),
    ("HTTP/1.1\r\n\r\n200 200 y", 200, False, None),
    ("HTTP/1.1\r\n\r\nz 200 y\r\n\r\nx", 200, True, "x"),
    ("HTTP/1.1\r\n\r\n200", None, False, None),
    ("", None, False, None),
    ("HTTP/1.1 200 OK\r\n\r\n", 200, True, ""),
]


def test_responses(spark):
    docs = spark.createDataFrame([(i, r[0]) for i, r in enumerate(RESPONSES)], "i INT, doc STRING")
    rows = docs.select("i", http.status("doc").alias("s"), http.is_ok("doc").alias("ok"), http.body("doc").alias("b")).collect()
    for row in rows:
        assert (row.s, row.ok, row.b) == RESPONSES[row.i][1:], RESPONSES[row.i][0]


def test_ok_pages_cut_the_body_at_nul(spark):
    pages = spark.createDataFrame(
        [(0, 0, "u", "HTTP/1.1 200 OK\r\n\r\nab\0cd"), (1, 0, "v", "HTTP/1.1 \x00200 OK\r\n\r\nab")],
        "seq BIGINT, file_no BIGINT, url STRING, doc STRING",
    )
    assert [(r.seq, r.body) for r in ok_pages(pages).collect()] == [(0, "ab")]
