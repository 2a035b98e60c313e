"""Dictionaries, postings, lists and runs against a sequential build."""

import random

import pytest
from pyspark.sql import functions as F

import sequential
from test_vbyte import decoded
from wordloom.operators import postings, runs
from wordloom.operators.tokens import doc_tokens
from wordloom.plans.index_build import Index, build_index
from wordloom.plans.stages import new_folder
from wordloom.schemas import PAGES
from wordloom.sinks import tables, text
from wordloom.sources.runs import read_runs

PIECES = ["the", "The", "a", "<b>", "</b>", "cat", "dog", "<script>", "</script>", "x1", "&amp;", "<h1>", "māori"]
PAGES_PER_FILE = 7


def _corpus(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = PIECES + [f"w{i}" for i in range(300)]
    pages = []
    for _ in range(n):
        # one URL holds a third of all pages
        url = "hot.example/" if rng.random() < 0.34 else f"Site{rng.randrange(60)}.example/p-{rng.randrange(3)}"
        html = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30)))
        pages.append((url, None if rng.random() < 0.1 else html))
    return pages


@pytest.fixture(scope="module")
def corpus():
    return _corpus()


def as_pages(spark, pages):
    rows = [
        (i, i // PAGES_PER_FILE, url, "HTTP/1.1 404 No\r\n\r\nzz" if html is None else f"HTTP/1.1 200 OK\r\n\r\n{html}")
        for i, (url, html) in enumerate(pages)
    ]
    return spark.createDataFrame(rows, PAGES)


@pytest.fixture(scope="module")
def index(spark, corpus):
    return Index(as_pages(spark, corpus))


@pytest.fixture(scope="module")
def expected(corpus):
    return sequential.build(corpus)


def _postings(frame):
    return {(r.word_id, r.doc_id): r.tf for r in frame.collect()}


def test_dictionaries(index, expected):
    urls, lexicon, _, _ = expected
    assert {r.url: r.doc_id for r in index.url_map.collect()} == urls
    assert {r.word: r.word_id for r in index.lexicon.collect()} == lexicon


def test_postings(index, expected):
    assert _postings(index.postings) == expected[2]
    assert index.postings.count() == len(expected[2])


def test_postings_by_shuffle_joins(spark, index, expected):
    options = {"small_bytes": 0}
    tokens = doc_tokens(index.page_tokens, index.url_map, **options)
    assert _postings(postings.postings(tokens, index.lexicon, **options)) == expected[2]


def test_result_does_not_depend_on_partitions(spark, corpus, expected):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert _postings(Index(as_pages(spark, corpus).repartition(5)).postings) == expected[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("block_bits", [0, 2, 16])
def test_revisits(index, expected, block_bits):
    found = {}
    visits = postings.visits(index.tokens, index.lexicon, block_bits=block_bits)
    rows = postings.revisit_postings(visits).collect()
    for row in sorted(rows, key=lambda r: (r.word_id, r.ordinal)):
        assert row.ordinal == len(found.setdefault(row.word_id, []))
        found[row.word_id].append([row.doc_id, row.tf])
    assert found == expected[3]


def test_revisits_by_file_start_anew_and_add_up(spark, corpus, index, expected):
    found = index.revisit_postings(by_file=True)
    lexicon, urls = expected[1], expected[0]
    for file_no in range(0, len(corpus) // PAGES_PER_FILE, 9):
        part = corpus[file_no * PAGES_PER_FILE : (file_no + 1) * PAGES_PER_FILE]
        part_urls, part_lexicon, _, visits = sequential.build(part)
        url_of = {i: u for u, i in part_urls.items()}
        lists = {
            lexicon[word]: [(urls[url_of[doc]], tf) for doc, tf in visits[word_id]] for word, word_id in part_lexicon.items()
        }
        rows = {}
        for r in sorted(found.where(F.col("file_no") == file_no).collect(), key=lambda r: (r.word_id, r.ordinal)):
            rows.setdefault(r.word_id, []).append((r.doc_id, r.tf))
        assert rows == lists
    assert _postings(runs.roll_up(found)) == expected[2]


def test_partials_roll_up_to_the_postings(index, expected):
    partials = index.partial_postings
    assert partials.groupBy("file_no", "word_id", "doc_id").count().where("count > 1").count() == 0
    assert _postings(runs.roll_up(partials)) == expected[2]


def test_unindexed_docs(index, expected, corpus):
    urls, _, counts, _ = expected
    missing = {(i, u) for u, i in urls.items()} - {(d, u) for u, i in urls.items() for _, d in counts if d == i}
    assert {(r.doc_id, r.url) for r in postings.unindexed_docs(index.url_map, index.tokens).collect()} == missing


@pytest.mark.parametrize("shard_docs", [1, 10, 1 << 16])
def test_lists_lines_and_bytes(index, expected, shard_docs):
    counts = expected[2]
    lists = {}
    for (word_id, doc_id), tf in sorted(counts.items()):
        lists.setdefault((word_id, doc_id // shard_docs), []).append((doc_id, tf))

    rows = postings.posting_lists(index.postings, shard_docs).collect()
    assert {(r.word_id, r.shard): [(p.doc_id, p.tf) for p in r.postings] for r in rows} == lists
    assert all(r.df == len(r.postings) for r in rows)

    rows = postings.global_index_lines(index.postings, shard_docs).collect()
    assert {(r.word_id, r.shard): r.line for r in rows} == {
        key: f"{key[0]} : " + "".join(f" {d} {tf}" for d, tf in entries) for key, entries in lists.items()
    }

    rows = postings.posting_bytes(index.postings, shard_docs).collect()
    coded = {(r.word_id, r.shard): decoded(bytes(r.bytes)) for r in rows}
    assert coded == {key: [n for entry in entries for n in entry] for key, entries in lists.items()}


def test_partial_lines(index):
    partials = index.partial_postings
    lists = {}
    for r in sorted(partials.collect(), key=lambda r: (r.file_no, r.word_id, r.doc_id)):
        lists.setdefault((r.file_no, r.word_id), []).append(f"< {r.doc_id} {r.tf} > ")
    rows = postings.partial_index_lines(partials).collect()
    assert {(r.file_no, r.word_id): r.line for r in rows} == {
        key: f"{key[1]} : " + "".join(pieces) for key, pieces in lists.items()
    }


def test_statistics(index, expected):
    urls, lexicon, counts, _ = expected
    lists = postings.posting_bytes(index.postings).agg(F.sum(F.octet_length("bytes"))).first()[0]
    stats = postings.index_stats(index.url_map, index.postings).first()
    assert stats.asDict() == {
        "n_words": len(lexicon),
        "n_urls": len(urls),
        "n_postings": len(counts),
        "n_bytes": lists + 5 * len(lexicon),
    }
    for row in postings.word_stats(index.postings).collect():
        of_word = {d: tf for (w, d), tf in counts.items() if w == row.word_id}
        assert (row.df, row.tf_sum, row.max_doc_id) == (len(of_word), sum(of_word.values()), max(of_word))


def _files(spark, path, *columns):
    """Rows per part file, files in the order of their names."""
    read = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_name", *columns)
    files = {}
    for row in read.collect():  # rows of a file come in its order
        files.setdefault((row.file_name, row.file_path), []).append(tuple(row)[2:])
    return [rows for _, rows in sorted(files.items())]


def test_runs_merge_and_compact(spark, index):
    path, compacted = new_folder(spark, "runs"), new_folder(spark, "compacted")
    partials = index.partial_postings
    tables.write_runs(partials, path)
    stored = read_runs(spark, path)
    bag = sorted((r.word_id, r.doc_id, r.tf) for r in partials.collect())

    merged = runs.merge_runs(stored.where("file_no < 20").drop("file_no"), stored.where("file_no >= 20").drop("file_no"))
    found = [(r.word_id, r.doc_id, r.tf) for r in merged.collect()]
    assert sorted(found) == bag
    order = [(word_id, doc_id) for word_id, doc_id, _ in found]
    assert order == sorted(order)

    listed = tables.write_compacted(stored, 10, compacted)
    rows = spark.read.parquet(compacted).collect()
    assert sorted((r.word_id, r.doc_id, r.tf) for r in rows) == bag
    expected_groups = sorted((r.file_no // 10, r.word_id, r.doc_id, r.tf) for r in stored.collect())
    assert sorted((r.file_no, r.word_id, r.doc_id, r.tf) for r in rows) == expected_groups
    assert {r.file_no for r in listed.collect()} == {g for g, *_ in expected_groups}
    again = new_folder(spark, "again")
    tables.write_compacted(read_runs(spark, compacted), 2, again)
    assert sorted((r.file_no, r.word_id, r.doc_id, r.tf) for r in read_runs(spark, again).collect()) == sorted((g // 2, *r) for g, *r in expected_groups)
    for rows in _files(spark, compacted, "word_id", "doc_id"):
        assert rows == sorted(rows)


def test_build_writes_the_text_formats(spark, index, expected, tmp_path):
    urls, lexicon, counts, _ = expected
    out = str(tmp_path / "index")
    build_index(index.pages, out)

    def lines(name):
        return [r.value for r in spark.read.text(f"{out}/{name}").orderBy("_metadata.file_name").collect()]

    assert lines("url_map_by_id") == [f"{i} {u}" for u, i in urls.items()]
    assert lines("lexicon_by_id") == [f"{i} {w}" for w, i in lexicon.items()]
    by_word = {}
    for (word_id, doc_id), tf in sorted(counts.items()):
        by_word[word_id] = by_word.get(word_id, f"{word_id} : ") + f" {doc_id} {tf}"
    assert lines("global_index") == [by_word[i] for i in range(len(lexicon))]
    assert _postings(spark.read.parquet(f"{out}/postings")) == counts

    text.write_lines(text.lexicon_lines_by_word(index.lexicon), f"{out}/lexicon_by_word", "word")
    assert lines("lexicon_by_word") == [f"{w} {i}" for w, i in sorted(lexicon.items())]
    text.write_lines(text.url_map_lines(index.url_map), f"{out}/url_map_by_url", "url")
    assert lines("url_map_by_url") == [f"{i} {u}" for u, i in sorted(urls.items())]

    partial = postings.partial_index_lines(index.partial_postings).where("file_no = 3").orderBy("word_id").collect()
    assert lines("partial_index/file_no=3") == [r.line for r in partial]


def test_repeated_positions_of_one_document_are_one_visit(spark):
    rows = [(0, 1, ["b", "a", "b"]), (0, 1, ["b"]), (1, 1, ["b"]), (2, 0, []), (3, 0, ["b"]), (3, 1, ["a"]), (4, 1, ["b"]), (5, 1, None)]
    tokens = spark.createDataFrame(rows, "seq long, doc_id long, tokens array<string>")
    lexicon = spark.createDataFrame([("a", 0, 2), ("b", 1, 5)], "word string, word_id long, n_pages long")
    for bits in (0, 1, 16):
        found = postings.revisit_postings(postings.visits(tokens, lexicon, block_bits=bits)).collect()
        assert sorted((r.word_id, r.ordinal, r.doc_id, r.tf) for r in found) == [(0, 0, 1, 2), (1, 0, 1, 4), (1, 1, 0, 1), (1, 2, 1, 1)]


def test_lines_by_shard_make_no_file_per_task_and_shard(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("id % 400 AS word_id", "id div 40 AS doc_id", "1L AS tf")
    before = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        text.write_lists(postings.global_index_lines(rows, 50), f"{tmp_path}/lines")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(list(tmp_path.glob("lines/shard=*/part-*"))) <= 20 + 8
    lines = spark.read.text(f"{tmp_path}/lines")
    assert lines.count() == rows.selectExpr("word_id", "doc_id div 50").distinct().count()
