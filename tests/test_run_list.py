import struct

import pytest

from wordloom.operators.runs import by_posting, merge_runs
from wordloom.plans.stages import stage
from wordloom.sources.run_list import TripleReader, read_listed, write_list, write_triples

RUNS = "file_no long, word_id long, doc_id long, tf long"


def _runs(spark, n=500):
    return spark.createDataFrame([(i % 5, i * 7 % 40, i, 1 + i % 300) for i in range(n)], RUNS)


def test_triples_come_back_by_their_list(spark, tmp_path):
    found = _runs(spark)
    files = stage(write_triples(by_posting(found, "file_no"), f"{tmp_path}/files"), "files").table
    assert sum(r.n for r in files.collect()) == 500
    write_list(files, f"{tmp_path}/list")
    (tmp_path / "files" / "9-leftover.run").write_bytes(b"x")  # of a task that ran twice: in no list
    rows = read_listed(spark, f"{tmp_path}/list", split="7")
    assert rows.rdd.getNumPartitions() >= 500 // 7
    assert sorted(map(tuple, rows.collect())) == sorted((r.word_id, r.doc_id, r.tf) for r in found.collect())
    merged = [(r.word_id, r.doc_id) for r in merge_runs(rows).collect()]
    assert merged == sorted(merged)


def test_a_file_of_the_list_is_sorted(spark, tmp_path):
    files = stage(write_triples(by_posting(_runs(spark), "file_no"), f"{tmp_path}/files"), "files").table
    for row in files.collect():
        data = open(row.file.removeprefix("file:"), "rb").read()
        records = list(struct.iter_unpack("<iii", data))
        assert len(records) == row.n and records == sorted(records) and records[0][:2] == (row.first_word, row.first_doc)


def test_lists_by_hand(spark, tmp_path):
    (tmp_path / "a.run").write_bytes(struct.pack("<6i", 1, 2, 3, 4, 5, 6))
    (tmp_path / "empty.run").write_bytes(b"")
    (tmp_path / "runs.txt").write_text(f"a.run\n\n  empty.run\nfile:{tmp_path}/a.run\n")
    assert sorted(map(tuple, read_listed(spark, f"{tmp_path}/runs.txt").collect())) == [(1, 2, 3), (1, 2, 3), (4, 5, 6), (4, 5, 6)]
    (tmp_path / "none.txt").write_text("")
    assert read_listed(spark, f"{tmp_path}/none.txt").count() == 0


@pytest.mark.parametrize("data, error", [(b"1" * 13, ValueError), (None, FileNotFoundError)])
def test_bad_files_are_refused(tmp_path, data, error):
    if data is not None:
        (tmp_path / "a.run").write_bytes(data)
    (tmp_path / "runs.txt").write_text("a.run\n")
    with pytest.raises(error):
        TripleReader({"list": f"file:{tmp_path}/runs.txt"}).partitions()


def test_values_above_32_bits_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, 1 << 31, 1)], RUNS)
    with pytest.raises(Exception, match="does not fit 32 bits"):
        write_triples(rows, f"{tmp_path}/files").collect()


def test_no_runs(spark, tmp_path):
    files = stage(write_triples(_runs(spark, 0), f"{tmp_path}/files"), "files").table
    write_list(files, f"{tmp_path}/list")
    assert read_listed(spark, f"{tmp_path}/list").count() == 0


def test_many_small_splits_share_tasks(spark, tmp_path):
    records = [(i % 50, i, 1 + i % 3) for i in range(6000)]
    for k in range(3):
        part = records[k::3]
        (tmp_path / f"{k}.run").write_bytes(b"".join(struct.pack("<3i", *r) for r in part))
    (tmp_path / "runs.txt").write_text("0.run\n1.run\n2.run\n")
    rows = read_listed(spark, f"{tmp_path}/runs.txt", split="1")
    assert 500 <= rows.rdd.getNumPartitions() <= 1024
    assert sorted(map(tuple, rows.collect())) == sorted(records)
    for split, most in ((1, 1024), (7, 861), (5000, 3)):
        parts = TripleReader({"list": f"file:{tmp_path}/runs.txt", "split": str(split)}).partitions()
        assert len(parts) <= most and all(sum(s.step for s in p.splits) <= max(12 * split, 12 << 22) for p in parts)
