import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from wordloom.plans.index_build import Index
from wordloom.sources import crawl
from wordloom.sources.pages import from_pairs, urls_of_pairs
from wordloom.sources.runs import read_triples

from sequential import build


def _documents(n, seed):
    rng = random.Random(seed)
    return [
        (f"host{rng.randrange(8)}.example/{rng.randrange(4)}?é", bytes(rng.randrange(256) for _ in range(rng.randrange(90))))
        for _ in range(n)
    ]


def _write_pair(folder, file_no, documents, last_newline=True, cut=0, extra=b""):
    index = b"\n".join(f"{url}  1 2 {len(doc)} 5 6 7".encode("latin-1") for url, doc in documents)
    data = b"".join(doc for _, doc in documents)
    (folder / f"{file_no}_index").write_bytes(gzip.compress(index + (b"\n" if last_newline and documents else b"")))
    (folder / f"{file_no}_data").write_bytes(gzip.compress(data[: len(data) - cut] + extra))


@pytest.mark.parametrize("one_task_bytes", [crawl.ONE_TASK_BYTES, 60])
def test_pairs_are_read_byte_for_byte(spark, tmp_path, one_task_bytes):
    parts = {0: _documents(5, 0), 2: _documents(40, 1), 10: [], 11: _documents(300, 2)}
    for file_no, documents in parts.items():
        _write_pair(tmp_path, file_no, documents, last_newline=file_no != 2)
    pairs = crawl.list_pairs(spark, str(tmp_path))
    assert sorted(r.file_no for r in pairs.collect()) == [0, 2, 10, 11]

    rows = sorted(crawl.read_pairs(pairs, one_task_bytes).collect(), key=lambda r: (r.file_no, r.line_no))
    expected = []
    for file_no, documents in parts.items():
        start = 0
        for line_no, (url, doc) in enumerate(documents):
            expected.append((file_no, line_no, url.encode("latin-1"), start, len(doc), doc))
            start += len(doc)
    assert [(r.file_no, r.line_no, bytes(r.url), r.start_at, r.length, bytes(r.doc)) for r in rows] == expected
    listed = crawl.read_page_index(pairs)
    assert sorted((r.file_no, r.line_no, bytes(r.url), r.length) for r in listed.collect()) == [
        (f, n, url, length) for f, n, url, _, length, _ in expected
    ]
    slices = crawl.page_slices(listed, block_bits=3).collect()
    assert sorted((r.file_no, r.line_no, r.start_at) for r in slices) == [(f, n, s) for f, n, _, s, _, _ in expected]


@pytest.mark.parametrize("files", [["7_index"], ["7_data"], ["a/3_index", "a/3_data", "b/3_index", "b/3_data"], ["a/3_index", "b/3_index", "b/3_data"]])
def test_lone_and_repeated_files_are_refused(spark, tmp_path, files):
    _write_pair(tmp_path, 0, [("u", b"abc")])
    for name in files:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(gzip.compress(b""))
    with pytest.raises(Exception, match=f"needs one index and one data file: .*{files[0]}"):
        crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path))).collect()


def test_every_pair_has_a_task_of_its_own(spark, tmp_path):
    for file_no in range(40):
        _write_pair(tmp_path, file_no * 3, [("u", b"abc")])
    rows = crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path)))
    assert rows.groupBy(F.spark_partition_id()).count().where("count > 1").count() == 0
    assert rows.rdd.getNumPartitions() == 40


def test_a_negative_length_is_refused(spark, tmp_path):
    (tmp_path / "0_index").write_bytes(gzip.compress(b"u 0 0 -2\n"))
    (tmp_path / "0_data").write_bytes(gzip.compress(b"ab"))
    with pytest.raises(Exception, match="line 0 has a negative length"):
        crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path))).collect()


def test_concatenated_gzip_members(spark, tmp_path):
    (tmp_path / "0_index").write_bytes(gzip.compress(b"u 0 0 2\n") + gzip.compress(b"v 0 0 3\n"))
    (tmp_path / "0_data").write_bytes(gzip.compress(b"ab") + gzip.compress(b"cde"))
    rows = crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path))).collect()
    assert sorted((bytes(r.url), bytes(r.doc)) for r in rows) == [(b"u", b"ab"), (b"v", b"cde")]


@pytest.mark.parametrize("damage, message", [({"cut": 1}, "ends inside page"), ({"extra": b"x"}, "more bytes")])
def test_damaged_pairs_are_refused(spark, tmp_path, damage, message):
    _write_pair(tmp_path, 0, [("u", b"abc"), ("v", b"defg")], **damage)
    with pytest.raises(Exception, match=message):
        crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path))).collect()


def test_index_of_pairs_equals_the_sequential_build(spark, tmp_path):
    rng = random.Random(4)
    pages, parts = [], {}
    for file_no in (0, 1, 9, 10):
        for _ in range(20):
            url, ok = f"Site{rng.randrange(9)}.example/", rng.random() < 0.8
            html = " ".join(rng.choice(["a", "B", "<b>", "</b>", "mã", "zz", f"w{rng.randrange(99)}"]) for _ in range(12))
            parts.setdefault(file_no, []).append(
                (url, (b"HTTP/1.0 200 OK" if ok else b"HTTP/1.0 500 No") + b"\r\n\r\n" + html.encode("utf-8"))
            )
            pages.append((url, html if ok else None))
    for file_no, documents in parts.items():
        _write_pair(tmp_path, file_no, documents)
    urls, lexicon, counts, _ = build(pages)
    pairs = crawl.list_pairs(spark, str(tmp_path))
    index = Index(from_pairs(crawl.read_pairs(pairs)), urls_of_pairs(crawl.read_page_index(pairs)))
    assert {r.url: r.doc_id for r in index.url_map.collect()} == urls
    assert {r.word: r.word_id for r in index.lexicon.collect()} == lexicon
    assert {(r.word_id, r.doc_id): r.tf for r in index.postings.collect()} == counts


@pytest.mark.parametrize("per_split", [1, 7, 1 << 20])
def test_binary_triples(spark, tmp_path, per_split):
    runs = {"a": [(0, 1, 2), (0, 3, 4), (2**31 - 1, 5, 6)], "b": [(i, i + 1, 1) for i in range(50)], "c": []}
    for name, records in runs.items():
        (tmp_path / name).write_bytes(b"".join(struct.pack("<3i", *r) for r in records))
    found = read_triples(spark, *[str(tmp_path / n) for n in runs], triples_per_split=per_split)
    assert found.columns == ["word_id", "doc_id", "tf"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(r for records in runs.values() for r in records)


def test_no_binary_triples_at_all(spark, tmp_path):
    (tmp_path / "empty").write_bytes(b"")
    assert read_triples(spark, str(tmp_path / "empty")).agg(F.count("*")).first()[0] == 0


def _scan(spark, tmp_path):
    return crawl.scan_pairs(crawl.list_pairs(spark, str(tmp_path)))


def test_a_sound_archive_is_scanned_as_it_is_read(spark, tmp_path):
    for file_no in (0, 1):
        _write_pair(tmp_path, file_no, _documents(30, file_no))
    _write_pair(tmp_path, 2, [])
    scanned = _scan(spark, tmp_path)
    expected = crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path)))
    assert sorted(map(tuple, crawl.good_pages(scanned).collect())) == sorted(map(tuple, expected.collect()))
    assert crawl.refused_pages(scanned).count() == 0
    assert sorted((r.file_no, r.rows, r.good, r.refused) for r in crawl.account(scanned).collect()) == [(0, 30, 30, 0), (1, 30, 30, 0)]


def test_damaged_pairs_are_set_aside(spark, tmp_path):
    documents = [(f"u{i}", b"x" * 50) for i in range(10)]
    _write_pair(tmp_path, 0, documents)
    _write_pair(tmp_path, 1, documents, cut=70)
    _write_pair(tmp_path, 2, documents, extra=b"more")
    _write_pair(tmp_path, 3, documents)
    lines = [b"u0 1 2 50", b"u1", b"u2 1 2 50"]
    (tmp_path / "3_index").write_bytes(gzip.compress(b"\n".join(lines)))
    _write_pair(tmp_path, 4, documents)
    (tmp_path / "4_index").write_bytes(gzip.compress(b"u0 1 2 -5 6\n"))
    rng = random.Random(1)
    noise = [(f"n{i}", bytes(rng.randrange(256) for _ in range(400))) for i in range(40)]
    for file_no, half in ((5, "data"), (6, "index")):
        _write_pair(tmp_path, file_no, noise)
        name = tmp_path / f"{file_no}_{half}"
        name.write_bytes(name.read_bytes()[: 6000 if half == "data" else 60])  # gzip streams cut short
    scanned = _scan(spark, tmp_path)
    found = {}
    for r in crawl.refused_pages(scanned).collect():
        found.setdefault(r.file_no, []).append((r.line_no, r.reason))
    assert 0 not in found
    assert sorted(found[1]) == [(8, crawl.CUT_SHORT), (9, crawl.NO_PLACE)]
    assert found[2] == [(10, crawl.MORE_DATA)]
    assert sorted(found[3]) == [(1, crawl.FEW_COLUMNS), (2, crawl.NO_PLACE)]
    assert found[4] == [(0, crawl.BAD_LENGTH)]
    accounts = {r.file_no: r for r in crawl.account(scanned).collect()}
    assert all(r.rows == r.good + r.refused for r in accounts.values())
    assert accounts[1].good == 8 and accounts[1].bytes == 400 and accounts[2].good == 10
    assert accounts[5].rows == 40 and 0 < accounts[5].good < 20 and sorted(found[5])[0][1] in (crawl.BAD_DATA, crawl.CUT_SHORT)
    assert found[6][-1][1].startswith(crawl.BAD_INDEX)
    with pytest.raises(Exception, match="ends inside page|fewer than 4|more bytes|negative length|Truncated"):
        crawl.read_pairs(crawl.list_pairs(spark, str(tmp_path))).count()
