import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash as s


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(x.encode(), 42).intdigest() for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def classes(prints, radius=3):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, v in enumerate(values):
        for w in values[:i]:
            if bin(v ^ w).count("1") <= radius:
                x, y = find(v), find(w)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def want(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = classes(prints)
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[root[p]] = min(low.get(root[p], i), i)
    return sorted([(i, f"{p:016x}", low.get(root[p])) for (i, _), p in zip(rows, prints)], key=str)


def test_fingerprints():
    for t in ["", " \t", "a", "A b", "a b c", "x  y\x0bz w É\x1cq é " * 9, "to be or not to be " * 100]:
        assert s.fingerprint(t.encode()) == plain_fingerprint(t)


def cloud(n, seed):
    r = random.Random(seed)
    out = [r.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        v = r.choice(out)
        for _ in range(r.randint(1, 4)):
            v ^= 1 << r.randrange(64)
        out.append(v)
    return [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(out)]


@pytest.mark.parametrize("density,shard_rows", [(1024, 20_000), (20, 20_000), (1 / 1000, 20_000), (1 / 10**6, 20_000), (1024, 30), (20, 4)])
def test_links_against_brute_force(spark, monkeypatch, density, shard_rows):
    """One tree, trees over bits of four, five and six blocks, shells, and pairs of blocks of what shells leave."""
    monkeypatch.setattr(s, "DENSITY", density)
    monkeypatch.setattr(s, "forest", lambda rows, radius, f=s.forest: f(rows, radius) if density >= 1 else s.masks(5 if density > 1e-4 else 6, radius, 25))
    values = cloud(150, 5) + [v ^ 0xFFFF for v in range(0, 1 << 12, 37)]  # the latter share a shard of one tree
    values = list(dict.fromkeys(values))
    links = s.near_links(spark.createDataFrame([(v,) for v in values], "print long"), shard_rows=shard_rows)
    got = {r.node: r.root for r in s.components(links).collect()}
    low, root = {}, classes([v & (1 << 64) - 1 for v in values])
    for v in values:
        low[root[v & (1 << 64) - 1]] = min(low.get(root[v & (1 << 64) - 1], v), v)
    assert {v: got.get(v, v) for v in values} == {v: low[root[v & (1 << 64) - 1]] for v in values}


def test_large_shard_in_memory():
    values = np.array(cloud(700, 6))
    same = np.zeros(len(values), np.int64)
    shards = s.Shards(3)
    a, b = shards.links(same, same, values, np.ones(len(values), bool))
    assert shards.near < shards.compared < 0.6 * shards.pairs and shards.pairs == len(values) * (len(values) - 1) // 2
    up = dict(zip(a.tolist(), b.tolist()))
    root = classes([int(v) & (1 << 64) - 1 for v in values])
    groups = {}
    for v in values.tolist():
        k = up.get(v, v)
        groups.setdefault(root[v & (1 << 64) - 1], set()).add(k)
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in s.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}
    assert s.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shards_over_many_batches():
    """A shard that many batches share, then small ones: the links of one batch with all rows."""
    values = np.array(cloud(400, 8))
    shard = np.sort(np.r_[np.zeros(500, np.int64), np.arange(len(values) - 500) // 7])
    columns = [np.zeros(len(values), np.int64), shard, values, np.ones(len(values), bool)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["tree", "shard", "print", "home"])
    whole = [np.concatenate(x) for x in zip(*s.Shards(3).of(iter([batch])))]
    for size in (1, 9, 200):
        parts = [np.concatenate(x) for x in zip(*s.Shards(3).of(batch.slice(i, size) for i in range(0, len(values), size)))]
        assert sorted(zip(*(x.tolist() for x in parts))) == sorted(zip(*(x.tolist() for x in whole)))


def test_pruning_is_told(spark):
    values = cloud(600, 9)
    distinct, pairs, compared, near = s.pruning(spark.createDataFrame([(v,) for v in values], "print long"))
    assert distinct == len(values) and pairs >= compared >= near > 0


def test_forest():
    assert [len(s.forest(n, 3)) for n in (0, 1000, 10**6, 10**8, 10**12)] == [1, 1, 4, 10, 20]
    for rows in (10**4, 10**6, 10**8, 10**12):
        union = s.forest(rows, 3)
        assert all(any(d & m == 0 for m in union) for d in (1 << a | 1 << b | 1 << c for a in range(0, 64, 5) for b in range(64) for c in range(0, 64, 3)))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, s.op7_simhash(spark, sf).collect()), key=str) == want(rows)


def test_hard_rows(spark):
    rows = [(4, None), (3, ""), (None, " "), (9, "one two"), (8, "ONE\ttwo"), (None, "only null"), (5, "w " * 200_000), (5, "w " * 200_000), (1, "w w w w")]
    out = s.group_near_copies(spark.createDataFrame(rows, "doc_id long, text string").withColumn("print", F.lit(1)).withColumn("fingerprint", F.lit(2)))
    assert out.columns == ["doc_id", "print", "fingerprint", "component_id"]
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in out.collect()], key=str) == want(rows)
    assert s.group_near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0
