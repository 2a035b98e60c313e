import brute
from pyspark.sql import functions as F
from wordloom.llm.quality import BASE, RULES, STANDARD, ablations, ledger, passes


def test_measures_equal_brute_force(messy):
    rows = ledger(messy.withColumn("t", F.col("text"))).withColumn("base", passes(BASE)).collect()
    assert len(rows) == messy.count()
    for r in rows:
        expected = brute.quality(r.t)
        assert {m: r[m] for m in expected} == expected
        assert r.base == (r.n_words >= 10 and 100 * r.n_repeat_words <= 20 * r.n_words)


def test_ablations_equal_a_count(messy, spark):
    table = ledger(messy)
    rows = table.collect()
    found = {r.rule: (r.n_failed, r.n_only) for r in ablations(table, STANDARD).collect()}
    for rule in RULES:
        if rule.name in STANDARD.rules:
            bits = [r.failed & STANDARD.mask for r in rows]
            assert found[rule.name] == (sum(b >> rule.bit & 1 for b in bits), sum(b == 1 << rule.bit for b in bits))


def test_clean_prose_stays_and_junk_goes(spark):
    prose = "The quick brown fox jumps over the lazy dog while many other animals look on, and none of them minds at all."
    rows = [(1, prose), (2, prose.upper()), (3, " ".join(w + "###" for w in prose.split())), (4, "buy now " * 40), (5, (prose[:40] + "\n") * 9), (6, "too short")]
    kept = {r.doc_id for r in ledger(spark.createDataFrame(rows, "doc_id long, text string")).where(passes(STANDARD)).collect()}
    assert kept == {1}


def test_empty_table(empty):
    assert ledger(empty).collect() == []
    assert ablations(ledger(empty), STANDARD).collect() == []
