import heapq
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions.times import NO_END, NO_START
from tickloom.operators import boards, merge, rejects, ring
from tickloom.operators.scans import position, running_max

SCHEMA = "unit int, src int, row_no long, ts_ns long"


def heap_merge(sources, windows):
    """sources: lists of rows (unit, src, row_no, ts); one record of each is held, the earliest goes out."""
    out, heads = [], []
    iters = [iter(s) for s in sources]

    def push(k):
        for row in iters[k]:
            heapq.heappush(heads, (row[3], k, row))
            return

    for k in range(len(sources)):
        push(k)
    while heads:
        ts, k, row = heapq.heappop(heads)
        start, end = windows.get(row[0], (NO_START, NO_END))
        if ts > end:
            continue
        push(k)
        if ts >= start:
            out.append(row)
    return out


def emit(spark, sources, windows=None, chunk=None):
    df = spark.createDataFrame([r for s in sources for r in s], SCHEMA)
    return [tuple(r) for r in merge.in_order(merge.emitted(df, windows, chunk)).select("unit", "src", "row_no", "ts_ns").collect()]


def source(k, times, unit=0):
    return [(unit, k, i, t) for i, t in enumerate(times)]


def test_merge_fixtures(spark):
    ts = lambda rows: [r[3] for r in rows]
    assert ts(emit(spark, [source(0, [100, 103, 105]), source(1, [101, 102, 106])])) == [100, 101, 102, 103, 105, 106]
    assert [r[1] for r in emit(spark, [source(0, [100, 200]), source(1, [100, 200])])] == [0, 1, 0, 1]
    assert [r[0] for r in emit(spark, [source(0, [200, 200]), source(1, [200, 200], 1)])] == [0, 0, 1, 1]
    assert ts(emit(spark, [source(0, [100, 200, 300, 400])], {0: (200, 300)})) == [200, 300]
    assert emit(spark, [source(0, [100, 200])], {0: (500, NO_END)}) == []
    two = emit(spark, [source(0, [100, 200, 300]), source(1, [120, 220, 320], 1)], {0: (150, 250)})
    assert [(r[3], r[0]) for r in two] == [(120, 1), (200, 0), (220, 1), (320, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_merge_of_unsorted_sources(spark, seed):
    r = random.Random(seed)
    sources = [source(k, [r.randrange(60) for _ in range(r.randrange(25))], k % 2) for k in range(5)]
    windows = {0: (r.randrange(30), 30 + r.randrange(30)), 1: (NO_START, r.randrange(60))}
    chunk = F.floor(F.col("row_no") / 4) if seed % 2 else None
    assert emit(spark, sources, windows, chunk) == heap_merge(sources, windows)


def test_sortedness(spark):
    df = lambda t: spark.createDataFrame(source(0, t), SCHEMA)
    assert merge.is_sorted(df([1, 2, 2, 5])) and not merge.is_sorted(df([1, 3, 2]), F.floor(F.col("row_no") / 2))


@pytest.mark.parametrize("chunked", [False, True])
def test_scans(spark, chunked):
    r = random.Random(3)
    rows = [(k, i, r.randrange(100)) for k in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, i int, v int")
    chunk = F.floor(F.col("i") / 7) if chunked else None
    for inclusive in (True, False):
        for x in running_max(df, ["k"], ["i"], F.col("v"), "m", chunk, inclusive).collect():
            assert x.m == max([v for k, i, v in rows if k == x.k and (i <= x.i if inclusive else i < x.i)], default=None)
    placed = position(df, [], ["i", "k"], "p", chunk).collect()
    assert {(x.k, x.i): x.p for x in placed} == {(k, i): n for n, (i, k) in enumerate(sorted((i, k) for k, i, _ in rows))}


BOOKS = "unit int, src int, row_no long, merge_ts long, ts_ns long, lid int, update_id long, px long"


def books(spark, ids, lid=0):
    return spark.createDataFrame([(0, 0, i, i, i, lid, u, 10 * i) for i, u in enumerate(ids)], BOOKS)


@pytest.mark.parametrize("chunk", [False, True])
def test_claims_against_a_loop(spark, chunk):
    r = random.Random(5)
    rows = [(0, 0, i, i, i, r.randrange(3), r.randrange(40), i) for i in range(120)]
    best, seen, want = {}, {}, {}
    for _, _, i, _, _, lid, uid, px in rows:
        if uid > best.get(lid, 0):
            best[lid] = uid
            seen[lid] = seen.get(lid, 0) + 1
            want[lid] = (lid, 2 * seen[lid], i, uid, px, uid)
    df = spark.createDataFrame(rows, BOOKS)
    claimed = boards.claim(df, ["lid"], chunk=F.floor(F.col("merge_ts") / 5) if chunk else None)
    assert {x.lid: tuple(x) for x in boards.board(claimed, ["px"], ["lid"]).collect()} == want
    plain = {x.lid: (x.update_id, x.px) for x in boards.latest(df, ["px"], ["lid"]).collect()}
    assert plain == {k: (v[3], v[4]) for k, v in want.items()}


def test_claims_from_a_table_and_zero(spark):
    best = spark.createDataFrame([(0, 7)], "lid int, best_uid long")
    got = [x.accepted for x in boards.claim(books(spark, [5, 8, 8, 3, 9]), ["lid"], best).orderBy("row_no").collect()]
    assert got == [False, True, False, False, True]
    assert [x.accepted for x in boards.claim(books(spark, [0, 0, 1]), ["lid"]).orderBy("row_no").collect()] == [False, False, True]
    counts = boards.dedup_counts(boards.claim(books(spark, [555, 100]), ["lid"])).first()
    assert (counts.emitted, counts.accepted, counts.deduped) == (2, 1, 1)


@pytest.mark.parametrize("n,capacity", [(10, 16), (16, 16), (50, 16), (33, 16)])
def test_ring(spark, n, capacity):
    df = spark.createDataFrame([(0, 0, i, i, i) for i in range(n)] + [(1, 1, 0, 5, 5)], SCHEMA.replace("ts_ns", "merge_ts") + ", ts_ns long")
    got = ring.tail(df, [0, 1, 2], capacity).orderBy("unit", "slot").collect()
    own = [x for x in got if x.unit == 0]
    assert [(x.slot, x.row_no, x.ring_idx, x.seq) for x in own] == [(i, i, i % capacity, 2 * i) for i in range(max(0, n - capacity), n)]
    assert [(x.unit, x.slot) for x in got if x.unit] == [(1, 0)]
    assert {x.unit: (x.published, x.wraps) for x in ring.wraps(df, capacity).collect()} == {0: (n, n // capacity if n > capacity else 0), 1: (1, 0)}
    for after in (0, 5, n):
        rows, lapped, on = ring.drain(ring.tail(df, [0], capacity), after, n, capacity)
        first = max(after, n - capacity)
        assert sorted(x.slot for x in rows.collect()) == list(range(first, n)) and lapped == max(0, n - after - capacity) and on == n


@pytest.mark.parametrize("seed", range(4))
def test_rejects_that_a_windowed_replay_sees(spark, seed):
    r = random.Random(seed)
    rows = [(0, k, i, r.randrange(50), r.choice([None, None, "bad_ts"])) for k in range(3) for i in range(20)]
    end = 30
    want = 0
    for k in range(3):
        past = top = 0
        for row in (x for x in rows if x[1] == k):
            if row[4]:
                want += 1
                continue
            top = max(top, row[3])
            past += top > end
            if past == 2:
                break
    df = spark.createDataFrame(rows, SCHEMA + ", reason string")
    merged = merge.with_merge_ts(df.where("reason IS NULL"))
    assert rejects.counted(df, merged, {0: (NO_START, end)}).count() == want


def test_unknown_symbols(spark):
    rows = [(k, i, f"X{(i * 3 + k) % 80:02}", "unknown_symbol") for k in range(2) for i in range(80)]
    df = spark.createDataFrame(rows, "src int, row_no long, symbol string, reason string")
    order = list(dict.fromkeys(s for _, _, s in sorted((i, k, s) for k, i, s, _ in rows)))[:64]
    assert {x.symbol for x in rejects.unknown_symbols(df).collect()} == set(order)
    lines = rejects.summary({"unknown_symbol": 160, "bad_ts": 2}, order)
    assert lines[0] == "rejected rows: 162 (2 bad_ts, 160 unknown_symbol)" and lines[1].startswith("unknown symbols and maybe more: ") and lines[1].count("X") == 64 and rejects.summary({}, []) == []
