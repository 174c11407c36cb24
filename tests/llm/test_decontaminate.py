import random
import re

import numpy as np
import pytest

from tickloom.llm import decontaminate as d

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def brute(text, items, window):
    ws = WORD.findall(fold(text))
    hit, names = set(), set()
    for item, t in items:
        iw = WORD.findall(fold(t))
        n = min(window, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for j in range(len(ws) - n + 1):
                if ws[j : j + n] == iw[i : i + n]:
                    hit.update(range(j, j + n))
                    names |= {item} - {None}
    return len(ws), len(hit), sorted(names), hit


def test_words():
    text = "A-Z é_ß 09\x7f\n\x00ÀX`{|}~[]^@ end"
    assert d.words(text.encode()) == WORD.findall(fold(text))


def test_suffix_order():
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 50, 400):
        text = np.r_[r.integers(0, 3, n - 1), 0].astype(np.int64)
        zeros = np.cumsum(text == 0)
        whole = [[(0, zeros[i]) if text[i] == 0 else (1, text[i]) for i in range(k, n)] for k in range(n)]
        assert d.suffix_order(text).tolist() == sorted(range(n), key=whole.__getitem__)
    assert d.suffix_order(np.r_[np.ones(3000, np.int64), 0]).tolist() == [3000, *range(2999, -1, -1)]


def test_wavelet_ranks():
    s = np.random.default_rng(3).integers(0, 11, 300)
    w = d.WaveletMatrix(s, 4)
    for c in range(12):
        at = np.arange(301)
        assert w.rank(np.full(301, c), at).tolist() == [int((s[:i] == c).sum()) for i in range(301)]


@pytest.mark.parametrize("sample", [1, 3, 8])
def test_index_locates(sample):
    r = np.random.default_rng(4)
    text = np.r_[r.integers(0, 4, 500), 0].astype(np.int64)
    index = d.FMIndex(text, 3, sample)
    for n in (1, 2, 4):
        patterns = r.integers(1, 4, (40, n))
        which, low, high = index.search(patterns.ravel(), np.arange(40) * n, n)
        got = {int(k): sorted(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(which, low, high)}
        want = {k: [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()] for k, p in enumerate(patterns)}
        assert got == {k: v for k, v in want.items() if v}


def test_window_classes():
    r = np.random.default_rng(5)
    ids = r.integers(1, 4, 300)
    for n in (1, 2, 3, 7, 10):
        starts = np.flatnonzero(r.random(300 - n + 1) < 0.8)
        classes, windows = d.window_classes(ids, starts, n), [tuple(ids[s : s + n]) for s in starts]
        assert len(set(zip(classes.tolist(), windows))) == len(set(classes.tolist())) == len(set(windows))


def test_long_runs_are_cut_with_overlap():
    r = random.Random(6)
    text = " ".join(r.choice("abc") for _ in range(900))
    items = [(str(i), " ".join(r.choice("abc") for _ in range(n))) for i, n in enumerate((3, 5, 6, 7, 30))]
    phrases = d.Phrases([(i, t.encode()) for i, t in items], 6)
    for size in (50, 10**6):
        counts, spans, names = d.shard_matches([text.encode(), b"", text.encode()[:99]], phrases, index_words=size)
        n, hit, found, places = brute(text, items, 6)
        assert counts.tolist() == [900, 0, 50] and sorted(names[0]) == found
        assert {p for a, b in zip(*spans[0]) for p in range(a, b)} == places and len(places) == hit


def test_text_ids(spark):
    items = spark.createDataFrame([("b", "one two"), ("a", "two three"), (None, "x")], "item_id string, text string")
    out = d.find_spans(spark.createDataFrame([("one two three x",)], "text string"), items, window=2).first()
    assert out.item_ids == ["a", "b"] and out.n_hit == 4


def test_memory_of_a_pass():
    """The windows of 8 MB of benchmark take little more room than its words."""
    import tracemalloc

    r = random.Random(7)
    vocab = [f"word{i}" for i in range(50_000)]
    items = [(str(i), " ".join(r.choices(vocab, k=100)).encode()) for i in range(8_500)]
    assert 7e6 < sum(len(t) for _, t in items) < d.PASS_BYTES
    tracemalloc.start()
    held = d.Phrases(items, 10)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held.least == 10 and now < 60e6 and peak < 150e6


def tables(spark, seed):
    r = random.Random(seed)
    vocab = ["Alpha", "beta", "gamma", "Straße", "é", "42", "zeta"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, say(r.randint(3, 12))) for i in range(8)] + [(3, say(6)), (None, say(7)), (90, None), (91, " ,, "), (92, "zeta"), (93, "unseen one")]
    docs = [(i, ", ".join([say(r.randint(0, 30)), r.choice(items[:9])[1].upper().replace("SSE", "ße").replace("É", "é"), "other words", say(r.randint(0, 9))])) for i in range(40)]
    docs += [(None, items[0][1]), (100, None), (101, ""), (5, docs[5][1]), (102, items[1][1] + "-" + items[1][1])]
    return docs, items


@pytest.mark.parametrize("seed,pass_bytes,shard_bytes", [(1, 1 << 20, 1 << 20), (2, 150, 1 << 20), (3, 40, 200)])
def test_against_brute_force(spark, seed, pass_bytes, shard_bytes):
    docs, items = tables(spark, seed)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = d.find_spans(df, bench, window=5, pass_bytes=pass_bytes, shard_bytes=shard_bytes).collect()
    got = sorted([(r.doc_id, r.text, r.n_words, r.n_hit, r.item_ids, sorted(x for s in r.spans for x in range(s.first, s.after))) for r in out], key=str)
    want = []
    for i, t in docs:
        n, h, names, hit = brute(t, items, 5)
        want.append((i, t, n, h, names, sorted(hit)))
    assert got == sorted(want, key=str)


def test_cut(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [("a é; One  two,THREE! z", ), ("two three", ), (None, ), ("one two three one two three", ), ("x one two three four. y", )]
    out = d.find_spans(spark.createDataFrame(rows, "text string"), bench, window=3, cut=True)
    assert sorted((r.text for r in out.collect()), key=str) == sorted(["a é; ! z", "two three", None, "", "x . y"], key=str)


def test_long_and_empty(spark):
    bench = spark.createDataFrame([(1, "to be or not to be")], "item_id long, text string")
    long = "to be or not to be " * 50_000
    df = spark.createDataFrame([(1, long, 2, "p")], "doc_id long, text string, n_hit int, item_ids string")
    out = d.find_spans(df, bench)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "item_ids", "spans"]
    assert (r := out.first()).n_words == r.n_hit == 300_000 and len(r.spans) == 1
    assert d.find_spans(df.limit(0), bench).count() == 0 and d.find_spans(df, bench.limit(0)).first().n_hit == 0
