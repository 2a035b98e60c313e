from pyspark.sql import functions as F

import brute
from wordloom.llm.secrets import BASE_RULES, RULES, Rule, read_ledger, scan


def test_equals_brute_force(messy, tmp_path):
    found = scan(messy, str(tmp_path / "ledger")).collect()
    texts = sorted(repr((r.doc_id, brute.secrets(r.text))) for r in messy.collect())
    assert sorted(repr((r.doc_id, [tuple(s) for s in r.spans if s.rule_no < len(BASE_RULES)])) for r in found) == texts


def test_failing_matches_hide_what_they_cover(spark, tmp_path):
    texts = ["secret=token:abcdefghi", "token==abcdef", "API_KEY = 'zyxwvu'", "é😀token:abcdef", "passwd: x password=123456 token=1234567", "AKIA" + "B" * 15, "g" + "a" * 24]
    rows = list(enumerate(texts))
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "l")).collect()}
    assert found == {i: brute.secrets(t) for i, t in rows}


def test_only_unseen_pairs_are_scanned(messy, spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = {(r.doc_id, r.blob): r.spans for r in scan(messy, ledger).collect()}
    blobs = read_ledger(spark, ledger).count()
    assert blobs == messy.select(F.coalesce("text", F.lit(""))).distinct().count()
    again = {(r.doc_id, r.blob): r.spans for r in scan(messy, ledger).collect()}
    assert again == first and read_ledger(spark, ledger).count() == blobs
    more = spark.createDataFrame([(900, "token: qwertyu"), (901, "plain")], "doc_id long, text string")
    scan(messy.select("doc_id", "text").unionByName(more), ledger).collect()
    assert read_ledger(spark, ledger).count() == blobs + 2
    newer = [*RULES, Rule("greek", 1, "alpha")]
    found = scan(messy, ledger, rules=newer).collect()
    assert read_ledger(spark, ledger).count() == 2 * blobs + 2
    assert sum(s.kind == "greek" for r in found for s in r.spans) == sum((r.text or "").count("alpha") for r in messy.collect())


def test_empty_table(empty, tmp_path):
    assert scan(empty, str(tmp_path / "ledger")).collect() == []


def test_raised_versions_and_removed_rules(spark, tmp_path):
    docs = spark.createDataFrame([(1, "token: abcdefgh secret=abcdefghijkl AKIA" + "B" * 16)], "doc_id long, text string")
    ledger = str(tmp_path / "ledger")

    def kinds(rules):
        return [(s.kind, s.rule_no) for s in scan(docs, ledger, rules=rules).collect()[0].spans]

    assign, access, _ = BASE_RULES
    assert kinds([assign, access]) == [("assign", 0), ("assign", 0), ("access", 1)]
    raised = Rule("assign", 2, assign.pattern, assign.group, 10)
    assert kinds([raised, access]) == [("assign", 0), ("access", 1)]
    assert kinds([access]) == [("access", 0)]
    assert kinds([assign, access]) == [("assign", 0), ("assign", 0), ("access", 1)]
