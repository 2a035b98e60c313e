"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from test_index import _corpus, as_pages
from wordloom.operators import dictionaries, postings, tokens
from wordloom.plans.index_build import Index
from wordloom.plans.stages import stage


@pytest.fixture(scope="module")
def index(spark):
    pages = stage(as_pages(spark, _corpus(60)), "pages").table
    return Index(pages)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def _optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_in_the_core(index):
    frames = [
        index.postings,
        index.partial_postings,
        index.revisit_postings(),
        tokens.word_contexts(index.pages),
        dictionaries.word_firsts(index.page_tokens),
        postings.posting_bytes(index.postings),
    ]
    for frame in frames:
        assert not re.search("Python|MapInArrow|MapInPandas|CartesianProduct|NestedLoop", _plan(frame))


def test_text_is_read_by_the_token_stage_only(index):
    assert "ReadSchema: struct<seq:bigint,url:string>" in _plan(dictionaries.url_firsts(index.pages))
    for frame in (index.postings, dictionaries.word_firsts(index.page_tokens), index.revisit_postings()):
        assert "doc:string" not in _plan(frame)
    assert "ReadSchema: struct<url:string,tokens:array<string>>" in _plan(index.postings)


def test_words_are_extracted_once(index):
    plan = _optimized(tokens.page_tokens(index.pages))
    assert plan.count("regexp_extract_all") == 2  # URL and body
    exploded = tokens.exploded(index.page_tokens, "seq").select("seq", "word")
    assert _optimized(exploded).count("explode") == 1


def test_words_are_counted_before_the_shuffle_and_without_sorting(index):
    plan = _plan(index.postings)
    assert plan.count("partial_count") == 1 and "SortAggregate" not in plan
    assert "SortAggregate" not in _plan(dictionaries.word_firsts(index.page_tokens))
    # postings of a small lexicon need one shuffle, the one of the counts
    assert plan.count("Exchange hashpartitioning") == 1


def test_only_the_top_of_the_block_tree_runs_in_one_task(index):
    firsts = dictionaries.word_firsts(index.page_tokens)
    plan = _plan(dictionaries.lexicon(stage(firsts, "firsts").table, last_seq=1 << 40))
    top = plan.index("Exchange SinglePartition")
    assert plan.count("Exchange SinglePartition") == 1
    # what goes there is summed per parent block, not per word
    assert "HashAggregate(keys=[_parent" in plan[top : top + 300]


def test_stages_are_in_the_named_folder(spark, index):
    root = spark.conf.get("spark.checkpoint.dir")
    assert all(root in name for name in index.page_tokens.inputFiles())
    assert index.page_tokens.agg(F.count("*")).first()[0] > 0


def test_contexts_are_found_in_one_scan_without_a_window(index):
    plan = _plan(tokens.word_contexts(index.pages))
    assert plan.count("FileScan") == 1 and "Window" not in plan and plan.count("Exchange") == 1


def test_lists_are_dealt_out_once(index):
    stored = stage(index.postings, "postings").table
    for frame in (postings.posting_bytes(stored), postings.global_index_lines(stored).sortWithinPartitions("shard", "word_id")):
        assert _plan(frame).count("Exchange") == 1


def test_what_is_walked_is_sent_once(index):
    plan = _plan(postings.visits(index.tokens, index.lexicon))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert "partial_collect_list" in plan  # a word's pages go together
