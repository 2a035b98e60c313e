import gzip

import pytest

import sequential
from test_crawl import _write_pair
from wordloom.sources.pages import from_pairs
from wordloom.sources.pair_stream import PairStreamReader, stream_pairs
from wordloom.streaming import index_stream


def _documents(first, n):
    return [(f"site{i % 7}.example/{i}", f"HTTP/1.1 200 OK\r\n\r\nword{i % 5} word{i}".encode()) for i in range(first, first + n)]


def test_pairs_that_land_out_of_order_give_the_one_pass_result(spark, tmp_path):
    landing, root = tmp_path / "crawl", str(tmp_path / "state")
    landing.mkdir()
    corpora = {n: _documents(40 * n, 40) for n in range(4)}
    for landed in ([3, 1], [0], [2]):
        for n in landed:
            _write_pair(landing, n, corpora[n])
        index_stream.index_stream(from_pairs(stream_pairs(spark, str(landing))), root).awaitTermination()
    assert [part.rows > 0 for part in index_stream.live_runs(spark, root)] == [False, True, True]  # nothing before pair 0
    corpus = [(url, doc.decode().split("\r\n\r\n")[1]) for n in range(4) for url, doc in corpora[n]]
    urls, words, counts, _ = sequential.build(corpus)
    assert {r.url: r.doc_id for r in index_stream.read_state(spark, root, "url_map").collect()} == urls
    assert {r.word: r.word_id for r in index_stream.read_state(spark, root, "lexicon").collect()} == words
    assert {(r.word_id, r.doc_id): r.tf for r in index_stream.global_postings(spark, root).collect()} == counts


def test_offsets(tmp_path):
    reader = PairStreamReader({"path": f"file:{tmp_path}"})
    assert reader.initialOffset() == reader.latestOffset() == {"pair": 0}
    for n in (2, 0):
        _write_pair(tmp_path, n, [("u", b"abc")])
    (tmp_path / "1_index").write_bytes(gzip.compress(b""))
    (tmp_path / "notes.txt").write_bytes(b"")
    assert reader.latestOffset() == {"pair": 1}  # pair 1 has no data file yet
    (tmp_path / "1_data").write_bytes(gzip.compress(b""))
    assert reader.latestOffset() == {"pair": 3}
    pairs = reader.partitions({"pair": 1}, {"pair": 3})
    assert [p.file_no for p in pairs] == [1, 2]
    assert [row for p in pairs for batch in reader.read(p) for row in batch.column("doc").to_pylist()] == [b"abc"]
    assert PairStreamReader({"path": f"file:{tmp_path}", "first": "2"}).latestOffset() == {"pair": 3}


def test_two_files_for_one_half_are_refused(tmp_path):
    _write_pair(tmp_path, 0, [("u", b"abc")])
    (tmp_path / "more").mkdir()
    _write_pair(tmp_path / "more", 0, [("u", b"abc")])
    with pytest.raises(ValueError, match="two files"):
        PairStreamReader({"path": f"file:{tmp_path}"}).latestOffset()


def test_many_pairs_share_tasks(tmp_path):
    for n in range(600):
        _write_pair(tmp_path, n, [("u", b"%d" % n)])
    reader = PairStreamReader({"path": f"file:{tmp_path}"})
    parts = reader.partitions({"pair": 3}, {"pair": 600})
    assert 199 <= len(parts) <= 256
    assert [doc for p in parts for batch in reader.read(p) for doc in batch.column("doc").to_pylist()] == [b"%d" % n for n in range(3, 600)]


def test_a_batch_reads_its_pages_once(spark, tmp_path):
    landing, root = tmp_path / "crawl", str(tmp_path / "state")
    landing.mkdir()
    for n in range(3):
        _write_pair(landing, n, _documents(40 * n, 40))
    rows, reads = spark.sparkContext.accumulator(0), from_pairs(stream_pairs(spark, str(landing)))

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    index_stream.index_stream(reads.mapInArrow(counted, reads.schema), root).awaitTermination()
    assert rows.value == 120
