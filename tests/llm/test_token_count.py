import random
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm.token_count import Merger, count_tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIB, TOOL = Tokenizer.from_file(FILE), Merger(FILE)
HARD = ["", " ", "\n\n  x", "aaaaaaaaaaaaaaa", "aaaa" * 500, "don't I'll 'S", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "  tail  ", "x　y z",
        "é̂ñ ß ΐ", "日本語テキスト 한국어", "😀👩‍👩‍👧 🏳️‍🌈", "१२३ ½ ² Ⅷ", "\x00\x01\t\r\n\x85 ", "𝒜𝔅 𐍈 \U0001fae8", "हिन्दी ก็", "0123456789 1,234.56", "ab" * 3000]


def library(texts):
    return [len(e.ids) for e in LIB.encode_batch(texts, add_special_tokens=False)]


def test_hard_texts():
    assert TOOL.count(HARD) == library(HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(texts):
    assert TOOL.count(texts) == library(texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=50), max_size=8))
def test_any_latin_text(texts):
    assert TOOL.count(texts) == library(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abtheinr '\n.<|>endoftx", max_size=80), max_size=8))
def test_merging(texts):
    assert TOOL.count(texts) == library(texts)


def test_long_unbroken_texts():
    """Random letters, base64-like text and unspaced scripts of a megabyte, in seconds."""
    r = random.Random(1)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", k=1_000_000)), "".join(r.choices("日本語文字列漢漢漢", k=300_000)), "a" * 1_000_000, "=" * 500_000 + " " * 500_000]
    for text in texts:
        began = time.perf_counter()
        got = TOOL.count([text])
        assert time.perf_counter() - began < 20
        assert got == library([text])
    assert max(map(len, TOOL.counts)) < 256


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abetth", min_size=250, max_size=700), min_size=1, max_size=4))
def test_merging_rank_by_rank(texts):
    assert TOOL.long_lengths([t.encode() for t in texts]).tolist() == library(texts)


def test_rows(spark):
    long = "the quick brown fox " * 20000
    rows = [(1, None, "x", 5), (1, "", "y", 6), (None, "a b c", None, None), (2, long, "z", 7), (2, long, "z", 7)]
    out = count_tokens(spark.createDataFrame(rows, "doc_id long, text string, extra string, n_tokens long"), FILE)
    assert out.columns == ["doc_id", "extra", "n_bytes", "n_tokens", "over_limit"]
    n = library([long])[0]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "x", 0, 0, False), (1, "y", 0, 0, False), (None, None, 5, 3, False), (2, "z", len(long), n, True), (2, "z", len(long), n, True)], key=str)
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


def test_query(spark):
    from tickloom.llm.token_count import op5_token_count

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    assert {r.doc_id: r.n_tokens for r in op5_token_count(spark, sf).collect()} == want
