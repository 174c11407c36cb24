import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import packing as p

FILE = public_tokenizers.path("word_bpe_49k.json")
LIB, TOOL = Tokenizer.from_file(FILE), p.WordIds(FILE)
HARD = ["", " ", "Don't STOP 'S ''s !'s", "a<|endoftext|>b<|startoftext|>", "<|", "x\x1cy\x85z\xa0w", "İstanbul ŉ ſ Σίσυφος ΟΔΟΣ", "é́ é ǅ ª º ½ ² Ⅷ", "日本 한국 😀👩‍👩‍👧", "1234 9.5%", "ß ẞ İ", "\x00\x01 \t\n\r", "ÀÉÎÕÜ straße"]


def library(texts):
    return [np.array(e.ids, "<u4").tobytes() for e in LIB.encode_batch(texts, add_special_tokens=False)]


def test_hard_texts():
    assert TOOL.encode(HARD) == library(HARD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40), max_size=6))
def test_any_latin_text(texts):
    assert TOOL.encode(texts) == library(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="abstrevl '!1<|>", max_size=60), max_size=6))
def test_any_text(texts):
    assert TOOL.encode(texts) == library(texts)


def squares(gaps, room):
    open_ = [g for g in gaps if 0 < g]
    return sum(open_.count(g) ** 2 for g in set(open_))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_each_choice_is_least(lengths):
    room = 12
    sequence, offset, gaps = p.sum_of_squares(np.array(lengths, np.int64), room)
    now: list[int] = []
    for s, k, at in zip(lengths, sequence.tolist(), offset.tolist()):
        after = [squares([*now[:j], g - s, *now[j + 1 :]], room) for j, g in enumerate(now) if g >= s] + [squares([*now, room - s], room)]
        assert at == (room - now[k] if k < len(now) else 0)
        now = [*now[:k], now[k] - s, *now[k + 1 :]] if k < len(now) else [*now, room - s]
        assert squares(now, room) == min(after)
    assert now == gaps.tolist()


def holds(rows, docs, length=4096):
    """rows: (doc_id, piece, start, length, ids_crc32, sequence_id, offset); gives the number of sequences."""
    want = []
    for (i, _), ids in zip(docs, library([t or "" for _, t in docs])):
        data = ids + b"\1\0\0\0"
        want += [(i, k, k * length, len(x) // 4, zlib.crc32(x)) for k, x in enumerate(data[a : a + 4 * length] for a in range(0, len(data), 4 * length))]
    assert sorted((r[:5] for r in rows), key=str) == sorted(want, key=str)
    used = {}
    for r in rows:
        used.setdefault(r[5], []).append((r[6], r[3]))
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(used)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [tuple(r) for r in p.op8_packing(spark, sf).collect()]
    assert holds(rows, docs) <= -(-sum(r[3] for r in rows) // 4096) + 2


def test_hard_rows(spark, tmp_path):
    docs = [(1, None), (1, ""), (None, "a b"), (None, "a b"), (2, "word " * 30_000), (3, "word " * 4095), (4, "word " * 4096)]
    docs += [(i, t) for i, t in enumerate(HARD, 10)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = p.op8_packing(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    holds([tuple(r) for r in out.collect()], docs)


def test_levels_and_ids(spark):
    docs = [(i, "word " * (i * 37 % 50)) for i in range(900)]
    parts = p.pieces(spark.createDataFrame(docs, "doc_id long, text string"), FILE, length=64, keep_ids=True)
    packed = p.pack(parts, 64, shard_pieces=50, open_tokens=2).localCheckpoint()
    n = holds([tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")) for r in packed.collect()], docs, 64)
    total = sum(r.length for r in packed.collect())
    assert n <= -(-total // 64) + 3
    whole = {r.sequence_id: bytes(r.ids) for r in p.assemble(packed).collect()}
    assert all(whole[r.sequence_id][4 * r.offset :][: 4 * r.length] == bytes(r.ids) for r in packed.collect())
    assert sum(map(len, whole.values())) == 4 * total


def test_empty_and_too_long(spark):
    df = spark.createDataFrame([], "doc_id long, text string, length int, offset int, _row int")
    out = p.pack_documents(df, FILE)
    assert out.count() == 0 and out.columns == ["doc_id", "_row", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    with pytest.raises(ValueError):
        p.pack(spark.createDataFrame([(5,)], "length long"), 4)


def test_pieces_over_half_a_sequence_end_in_bounded_shards(spark, monkeypatch):
    """200,000 pieces of 2,100 tokens, of which no two share a sequence, and few short ones: no shard holds more than its share,
    levels end, and there are no more sequences than long pieces."""
    lengths = [2100] * 200_000 + [300] * 500
    parts = spark.range(len(lengths)).select("id", F.when(F.col("id") < 200_000, 2100).otherwise(300).cast("long").alias("length")).repartition(8)
    seen = []
    real = p.written
    monkeypatch.setattr(p, "written", lambda df, name, **o: (seen.append(name), real(df, name, **o))[1])
    got = p.pack(parts, shard_pieces=2_000).toPandas()
    assert seen.count("placed") <= p.LEVELS
    assert len(got) == len(lengths) and got["sequence_id"].nunique() == 200_000
    largest = got.assign(shard=got["sequence_id"] // (1 << p.SEQUENCE_BITS)).groupby("shard").size().max()
    assert largest < 1.2 * 2_000
    used = got.sort_values(["sequence_id", "offset"])
    ends = used["offset"] + used["length"]
    start = used["sequence_id"] != used["sequence_id"].shift()
    assert (used["offset"][start] == 0).all() and (used["offset"][~start] == ends.shift()[~start]).all() and ends.max() <= 4096


@pytest.mark.parametrize("seed", range(2))
def test_numbers_differ_between_levels_and_shards(spark, seed):
    """Lengths of all kinds in very small shards: many levels, and each sequence's pieces lie end to end."""
    rng = np.random.default_rng(seed)
    lengths = np.r_[rng.integers(1, 4097, 800), rng.integers(1900, 2300, 800)].tolist()
    got = p.pack(spark.createDataFrame([(int(n),) for n in lengths], "length long"), shard_pieces=40).toPandas()
    assert sorted(got["length"]) == sorted(lengths)
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist() and own["length"].sum() <= 4096
    assert got["sequence_id"].nunique() <= 1.12 * sum(lengths) / 4096 + 1 or got["sequence_id"].nunique() <= 1.02 * len(p.sum_of_squares(np.sort(lengths)[::-1].astype(np.int64), 4096)[2])
