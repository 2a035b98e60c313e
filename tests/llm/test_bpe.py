import brute
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from wordloom.llm import bpe, quality, words

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def codes(texts):
    flat, cuts = bpe.encode_texts(PATH, texts)
    return [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbtheréÉΣσ's<|>endoftext 1½٣中😀\n\t\0_-aaaa"), max_size=40), max_size=5))
def test_equals_the_library(texts):
    assert codes(texts) == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["<|endoftext|>", "x<|startoftext|><|endoftext|>y", "aaaaaaaaaaaaaaaa", "don't we'LL", "İstanbul ΑΣ", "é"])
def test_special_tokens_runs_and_case(text):
    assert codes([text]) == [LIBRARY.encode(text, add_special_tokens=False).ids]


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i % 7} the end" for i in range(200)]
    before = codes(texts)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    monkeypatch.setattr(bpe, "INDEXED_WORDS", 13)
    assert [codes([t])[0] for t in texts] == before


def test_tables(messy, empty):
    rows = {(r.doc_id, r.text) for r in messy.collect()}
    coded = bpe.decode(bpe.encode(messy.withColumn("t", F.col("text")), PATH, decoded="one"), PATH, text="two")
    found = coded.collect()
    assert len(found) == messy.count() and {(r.doc_id, r.t) for r in found} == rows
    for r in found:
        ids = LIBRARY.encode(r.t or "", add_special_tokens=False).ids
        assert r.ids == ids and r.one == r.two == LIBRARY.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, PATH).collect() == []
    assert brute.sha("") != brute.sha("a")


def test_decoded_at_once_equals_one_by_one():
    codes, cuts = bpe.encode_texts(PATH, ["", "x<|endoftext|>y é", None, "don't", "a b c", ""])
    found = bpe._decoded(bpe.load(PATH), pa.array(codes), pa.array(cuts, pa.int32()))
    assert found.to_pylist() == [bpe.decode_ids(bpe.load(PATH), codes[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
    assert found.type == pa.string()


def test_tasks_leave_nothing_in_their_workers(messy):
    def left(batches):
        for batch in batches:
            size = bpe._codes.cache_info().currsize + len(words._powers[0]) - 1
            yield pa.RecordBatch.from_pydict({"size": [size] * batch.num_rows})

    long = messy.select("doc_id", F.repeat("text", 20).alias("text"))
    long.select(quality.measurements(F.col("text"))).write.format("noop").mode("overwrite").save()
    assert {r.size for r in messy.select("doc_id").mapInArrow(left, "size long").collect()} == {0}
    bpe.encode(long, PATH, decoded="decoded").write.format("noop").mode("overwrite").save()
    assert {r.size for r in messy.select("doc_id").mapInArrow(left, "size long").collect()} == {0}
