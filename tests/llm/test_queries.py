"""The registered queries: against their SQL, or brute force, on the smallest table set."""

import zlib
from pathlib import Path

import __spark_entry__ as entry
import brute
import duckdb
import pytest
from wordloom.llm.queries import ORACLES

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(TABLES).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}


def run(spark, name):
    return entry.queries()[name](spark, TABLES)


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found, expected = run(spark, name), connection.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(
        tuple(r[expected.columns.index(c)] for c in columns) for r in expected.fetchall()
    )


def test_jaccard(spark, texts):
    rows = sorted(texts.items())
    expected = brute.components(rows, 4, 85)
    found = run(spark, "op2_jaccard_join")
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(map(tuple, found.collect())) == [(d, *expected[i]) for i, (d, _) in enumerate(rows)]


def test_secrets(spark, texts):
    rows = run(spark, "op6_secret_scan").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        found = brute.secrets(texts[r.doc_id])
        base = [f"{k}:{a}:{b}" for a, _, b, k in found]
        assert r.base_sha256 == brute.sha(",".join(base))
        kinds = [k for *_, k in found]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and [int(x.split(":")[1]) for x in spans] == sorted(int(x.split(":")[1]) for x in spans)


def test_bpe(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    rows = run(spark, "op3_bpe").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(decoded))


def test_mixing(spark, texts):
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    sizes = {d: len(brute.words(t)) for d, t in texts.items()}
    of_source = {s: sum(n for d, n in sizes.items() if sources[d] == s) for s in set(sources.values())}
    order = sorted(of_source, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        level = (sum(of_source.values()) - sum(target.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * of_source[s]}
        if not over:
            break
        target |= {s: 3.0 * of_source[s] for s in over}
        open_ -= over
    target |= {s: level * weights[s] for s in open_}
    rows = run(spark, "op5_mixing").collect()
    assert {r.doc_id: (r.size, r.source_size) for r in rows} == {d: (sizes[d], of_source[sources[d]]) for d in texts}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        assert abs(r.target - target[sources[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[sources[r.doc_id]] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(n for d, n in sizes.items() if sources[d] == s)
    assert sorted(map(tuple, run(spark, "op5_mixing").collect())) == sorted(map(tuple, rows))


def test_sharding(spark, texts):
    rows = run(spark, "op7_sharding").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_quality(spark, texts):
    rows = run(spark, "op8_quality_rules").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        m = brute.quality(texts[r.doc_id])
        assert {k: r[k] for k in m} == m
        assert r.base_failed == (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"])
        assert not (r.base_failed and r.kept)


def test_toxicity(spark, texts):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    rows = run(spark, "op9_toxicity").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out and labels.get(r.doc_id) is not None:
            assert r.predicted == labels[r.doc_id]


def test_tampered_leaves(spark, texts):
    rows = run(spark, "op11_merkle_manifest").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and len({r.root for r in rows}) == 1
    for r in rows:
        text = texts[r.doc_id]
        changed = text is not None and text != text.translate(brute.LOWER) and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.verified == (not changed)


def test_suffixes(spark, texts):
    ids = sorted(texts)
    expected = dict(zip(ids, brute.passages([texts[i] for i in ids], 200)))
    for r in run(spark, "op10_suffix_dedup").collect():
        removed, spans, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len((texts[r.doc_id] or "").encode()), removed, spans, brute.sha(kept))


def test_pipeline(spark, texts):
    import corpus_pipeline
    from wordloom.llm.quality import STANDARD, ledger, passes
    from wordloom.plans.stages import stage

    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, TABLES)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in ledger(docs).where(passes(STANDARD)).collect()}
    lined = stage(corpus_pipeline.dedup_lines(spark, good, TABLES), "lined").table
    assert lined.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    expected = brute.line_dedup(rows)
    assert {r.doc_id: r.text for r in lined.collect()} == {d: expected[d, t][2] for d, t in rows}
    one = corpus_pipeline.one_of_near_duplicates(spark, lined, TABLES)
    assert one.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in lined.collect())
    classes = brute.components(rows, 5, 80)
    assert sorted(r.doc_id for r in one.collect()) == [d for i, (d, _) in enumerate(rows) if classes[i][1] == d]
    mixed = corpus_pipeline.mix_sources(spark, one, TABLES)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in one.collect()}
    run_rows = run(spark, "pipeline").collect()
    assert sorted(r.doc_id for r in run_rows) == sorted(r.doc_id for r in mixed.collect())
