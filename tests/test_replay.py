import hashlib
import json
import logging
import threading
import time

import pytest

from tickloom.errors import Error, ReplayError, SegmentState
from tickloom.operators.segments import HEADERS, Header, Segments, segment_bytes, segment_check
from tickloom.plans import cli, config
from tickloom.plans.replay import run
from tickloom.streaming.paced import PacedReplay, Stopper

B = 1782204109 * 10**9
MS = 10**6
BBO = "ts,symbol,update_id,bid_px,bid_qty,ask_px,ask_qty\n"
TRADE = "ts,symbol,side,px,qty\n"


def at(ms):
    return B + ms * MS


def entry(d, path, kind="book", **more):
    return {"input": {"dir": str(d), "kind": kind, "format": more.pop("format", "csv")}, "output": {"path": path, "create": more.pop("create", True)}, **more}


def play(spark, tmp_path, *entries, **top):
    cfg = config.parse_config({"realtime": 0, "replays": list(entries), **top})
    return run(spark, cfg, f"{tmp_path}/seg"), Segments(spark, f"{tmp_path}/seg")


def slots(segments, name):
    return {r.lid: r for r in segments.read(name).where("seq > 0").collect()}


def quotes(folder):
    folder.mkdir(exist_ok=True)
    (folder / "a.book.csv").write_text(BBO + f"{at(501)},SOLUSDT,100,68.84,1906.67,68.85,1260.72\n{at(550)},BNBUSDT,5000,600.1,10,600.2,12\n{at(601)},SOLUSDT,101,68.85,1900.00,68.86,1200.00\n{at(701)},SOLUSDT,99,99.99,1,99.99,1\n")
    return folder


def deals(folder):
    folder.mkdir(exist_ok=True)
    (folder / "t.trade.csv").write_text(TRADE + "".join(f"{at(ms)},{s},{side},{px},{q}\n" for ms, s, side, px, q in [
        (501, "SOLUSDT", 0, "68.84", "2.5"), (502, "BNBUSDT", 1, "600.1", "10"), (503, "SOLUSDT", 1, "68.85", "0.125"), (504, "BNBUSDT", 0, "600.25", "3"), (505, "SOLUSDT", 0, "68.8", "100"), (506, "BNBUSDT", 1, "599.99", "0.001")]))
    return folder


def test_top_of_book(spark, tmp_path):
    report, seg = play(spark, tmp_path, entry(quotes(tmp_path / "in"), "/bbo"))
    got = slots(seg, "/bbo")
    assert set(got) == {7, 19} and seg.read("/bbo").count() == 27
    assert (int(got[19].update_id), got[19].bid_px, got[19].ask_px, got[19].seq, got[19].price_scale) == (101, 6885, 6886, 4, 2)
    assert (int(got[7].update_id), got[7].bid_px, got[7].ask_px, got[7].bid_qty) == (5000, 6001, 6002, 10)
    assert (report.book, report.deduped, report.skipped) == (4, {0: 1}, {})


def test_depth_25(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    names = ["", *(f"_{k}" for k in range(1, 25))]
    def line(ms, uid, bid, ask, bq, aq):
        return f"{at(ms)},SOLUSDT,{uid}," + ",".join(f"{(bid - k) / 100:.2f},{bq + k},{(ask + k) / 100:.2f},{aq + k}" for k in range(25)) + "\n"
    stale = f"{at(3)},SOLUSDT,299" + ",99.99,1,99.99,1" * 25 + "\n"
    (d / "x.book.csv").write_text("ts,symbol,update_id," + ",".join(f"bid_px{s},bid_qty{s},ask_px{s},ask_qty{s}" for s in names) + "\n" + line(1, 300, 6884, 6885, 10, 20) + line(2, 301, 6885, 6886, 15, 25) + stale)
    report, seg = play(spark, tmp_path, entry(d, "depth"))
    r = slots(seg, "depth")[19]
    level = lambda k: (r.bid_px[k], r.ask_px[k], r.bid_qty[k], r.ask_qty[k])
    assert (int(r.update_id), r.depth, r.price_scale, r.qty_scale) == (301, 25, 2, 0) and report.deduped == {0: 1}
    assert [level(k) for k in (0, 12, 24)] == [(6885, 6886, 15, 25), (6873, 6898, 27, 37), (6861, 6910, 39, 49)]


def test_trades(spark, tmp_path):
    report, seg = play(spark, tmp_path, entry(deals(tmp_path / "in"), "ring", "trade"))
    rows, lapped, on = seg.drain("ring", 0)
    got = rows.orderBy("slot").collect()
    assert [(r.px, r.price_scale, r.qty, r.qty_scale) for r in got] == [(6884, 2, 25, 1), (6001, 1, 10, 0), (6885, 2, 125, 3), (60025, 2, 3, 0), (688, 1, 100, 0), (59999, 2, 1, 3)]
    assert [r.exch_ns for r in got] == [at(ms) for ms in range(501, 507)] and (lapped, on, report.trade) == (0, 6, 6)


def test_units_and_windows(spark, tmp_path):
    day = 1782205200 * 10**9
    for name, sym, first in (("a", "SOLUSDT", 100), ("b", "BNBUSDT", 200)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.book.csv").write_text(BBO + "".join(f"{day + i * 10**9},{sym},{first + i},1,1,2,1\n" for i in range(2 if name == "a" else 3)))
    report, seg = play(spark, tmp_path, entry(tmp_path / "a", "A"), entry(tmp_path / "b", "B", end="2026-06-23 09:00:01"), entry(deals(tmp_path / "t"), "T", "trade", start="2026-06-24 00:00:00"))
    assert {k: int(r.update_id) for k, r in slots(seg, "A").items()} == {19: 101} and {k: int(r.update_id) for k, r in slots(seg, "B").items()} == {7: 201}
    assert (report.book, report.trade) == (4, 0) and seg.read("T").count() == 0


def digest(segments, name):
    return hashlib.sha256(repr(sorted(map(tuple, segments.read(name).collect()))).encode()).hexdigest()


def test_equal_runs(spark, tmp_path):
    inputs = entry(quotes(tmp_path / "q"), "b"), entry(deals(tmp_path / "d"), "t", "trade")
    seen = set()
    for _ in range(2):
        _, seg = play(spark, tmp_path, *inputs)
        seen.add((digest(seg, "b"), digest(seg, "t"), seg.header("b"), seg.header("t")))
    assert len(seen) == 1 and seg.header("b") == HEADERS["bbo"]


def test_attaching(spark, tmp_path):
    board, log = entry(quotes(tmp_path / "q"), "b"), entry(deals(tmp_path / "d"), "t", "trade")
    play(spark, tmp_path, board, log)
    (tmp_path / "q" / "a.book.csv").write_text(BBO + f"{at(1)},SOLUSDT,101,1,1,1,1\n{at(2)},SOLUSDT,102,7.5,1,8,1\n")
    report, seg = play(spark, tmp_path, {**board, "output": {"path": "b", "create": False}}, {**log, "output": {"path": "t", "create": False}})
    got = slots(seg, "b")
    assert (got[19].seq, int(got[19].update_id), got[19].bid_px, got[7].seq, got[7].bid_px) == (6, 102, 75, 2, 6001) and report.deduped == {0: 1}
    assert sorted(r.slot for r in seg.read("t").collect()) == list(range(12)) and seg.head("t") == 12
    with pytest.raises(ReplayError) as e:
        play(spark, tmp_path, {**log, "output": {"path": "b", "create": False}})
    assert e.value.code is Error.SEGMENT_MISMATCH


def test_ring_wraps_and_lapped_reader(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.trade.csv").write_text(TRADE + "".join(f"{i},SOLUSDT,0,{i},1\n" for i in range(9000)))
    report, seg = play(spark, tmp_path, entry(tmp_path / "in", "r", "trade"))
    rows, lapped, on = seg.drain("r", 100)
    assert report.wraps == {0: 2} and lapped == 9000 - 4096 - 100 and on == 9000 and sorted(r.px for r in rows.collect()) == list(range(9000 - 4096, 9000))


def test_segment_checks():
    assert [segment_bytes(x) for x in ("bbo", "depth", "trade")] == [2048, 12416, 262272]
    want = HEADERS["bbo"]
    change = lambda **k: segment_check(Header(**{**want.__dict__, **k}), want)
    assert [change(), change(magic=1, kind=9), change(layout_version=1), change(kind=2), change(capacity=1), change(schema_hash="0"), change(created_ns=5)] == [
        SegmentState.OK, SegmentState.BAD_MAGIC, SegmentState.BAD_VERSION, SegmentState.BAD_KIND, SegmentState.SIZE_MISMATCH, SegmentState.SCHEMA_DRIFT, SegmentState.OK]


def test_bad_files_and_rows(spark, tmp_path, caplog):
    d = quotes(tmp_path / "in")
    (d / "0.book.csv").write_text("ts,symbol\n1,2\n")
    (d / "z.book.csv").write_text(BBO + f"x,SOLUSDT,1,1,1,1,1\n{at(1)},BADSYM,556,1,2,3,4\n{at(2)},OTHER,556,1,2,3,4\n{at(3)},SOLUSDT\n")
    with caplog.at_level(logging.INFO, "tickloom"):
        report, _ = play(spark, tmp_path, entry(d, "b"))
    assert report.skipped == {"bad_ts": 1, "unknown_symbol": 2, "malformed": 1} and report.unknown == ["BADSYM", "OTHER"]
    assert any("0.book.csv" in m and "the header lacks a column" in m for m in caplog.messages) and any("rejected rows: 4 (1 malformed, 1 bad_ts, 2 unknown_symbol)" in m for m in caplog.messages)
    (tmp_path / "none").mkdir()
    with pytest.raises(ReplayError):
        play(spark, tmp_path, entry(tmp_path / "none", "b"))


def test_depths_must_agree(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    book = {"ts": at(1), "symbol": "SOLUSDT", "update_id": 1, "bid_px": "1", "bid_qty": "1", "ask_px": "2", "ask_qty": "1"}
    five = book | {f"{f}_{k}": "1" for f in ("bid_px", "bid_qty", "ask_px", "ask_qty") for k in range(1, 5)}
    (d / "a.book.json").write_text(json.dumps(five) + "\n" + json.dumps(book | {"update_id": "2"}))
    _, seg = play(spark, tmp_path, entry(d, "x", format="auto"))
    assert slots(seg, "x")[19].depth == 1  # a later row may have a depth of its own
    (d / "b.book.json").write_text(json.dumps(book))
    with pytest.raises(ReplayError) as e:
        play(spark, tmp_path, entry(d, "x", format="json"))
    assert e.value.code is Error.BOOK_DEPTH_UNSUPPORTED


GOOD = {"input": {"dir": "d"}, "output": {"path": "p"}}


def test_config_defaults():
    c = config.parse_config({"replays": [GOOD]})
    assert (c.realtime, c.init_ts, c.log_level, c.progress_sec) == (1.0, None, "info", 5)
    assert (c.replays[0].input.format, c.replays[0].input.kind, c.replays[0].output.create) == ("csv", "book", True)
    assert config.parse_config({"replays": [GOOD], "init_ts": "1970-01-01 00:00:01"}).init_ts == 10**9 and config.parse_config({"replays": [GOOD], "init_ts": 7}).init_ts == 7


@pytest.mark.parametrize("table", [
    {"realtime": 2.0, "replays": [GOOD]}, {"realtime": float("nan"), "replays": [GOOD]}, {"replays": []}, {}, {"replays": [GOOD, GOOD]}, {"replays": [{"output": {"path": "p"}}]}, {"replays": [{"input": {}, "output": {}}]},
    {"replays": [{"input": {"kind": "x"}, "output": {"path": "p"}}]}, {"replays": [{"input": {"format": "parquet"}, "output": {"path": "p"}}]}, {"replays": [GOOD | {"start": "2026-02-01 00:00:00", "end": "2026-01-01 00:00:00"}]},
    {"replays": [GOOD | {"start": "yesterday"}]}, {"replays": [GOOD | {"start": 5}]}, {"replays": [GOOD], "init_ts": "x"}, {"replays": [5]}])
def test_config_rejected(table):
    with pytest.raises(ReplayError) as e:
        config.parse_config(table)
    assert e.value.code is Error.CONFIG_INVALID


def test_config_accepted():
    same = {"start": "2026-01-01 00:00:00", "end": "2026-01-01 00:00:00"}
    assert config.parse_config({"replays": [GOOD | same, {"input": {"dir": "d", "format": "auto"}, "output": {"path": "q"}}]})


def test_command_line(tmp_path):
    f = tmp_path / "job.toml"
    f.write_text('realtime = 0.5\n[[replays]]\ninput = {dir = "d"}\noutput = {path = "p"}\n')
    cfg, _ = cli.settings(["--config", str(f), "--realtime", "0", "--init_ts", "5", "--progress-sec", "9", "--log-level", "warn"])
    assert (cfg.realtime, cfg.init_ts, cfg.progress_sec, cfg.log_level) == (0.0, 5, 9, "warn")
    assert cli.main(["--config", str(f), "--dry-run"]) == 0 and cli.main(["--config", str(tmp_path / "no.toml")]) == 1 and cli.main(["--config", str(f), "--realtime", "3"]) == 1
    f.write_text("x = [")
    assert cli.main(["--config", str(f)]) == 1
    with pytest.raises(SystemExit):
        cli.settings(["--wrong"])


@pytest.mark.parametrize("realtime", [0.0, 1.0])
def test_paced_replay_gives_the_batch_result(spark, tmp_path, realtime):
    entries = [entry(quotes(tmp_path / "q"), "b"), entry(deals(tmp_path / "d"), "t", "trade")]
    _, batch = play(spark, tmp_path, *entries)
    cfg = config.parse_config({"realtime": realtime, "replays": entries})
    paced = PacedReplay(spark, cfg, f"{tmp_path}/paced", f"{tmp_path}/work")
    began = time.monotonic()
    report = paced.play()
    assert realtime == 0 or time.monotonic() - began >= 0.2
    seg = Segments(spark, f"{tmp_path}/paced")
    assert digest(seg, "b") == digest(batch, "b") and digest(seg, "t") == digest(batch, "t")
    assert (report.book, report.trade, report.deduped) == (4, 6, {0: 1})


def test_stop(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "x.trade.csv").write_text(TRADE + f"0,SOLUSDT,0,1,1\n{3600 * 10**9},SOLUSDT,0,2,1\n")
    cfg = config.parse_config({"realtime": 1, "replays": [entry(d, "t", "trade")]})
    stopper = Stopper()
    threading.Timer(8, stopper.event.set).start()
    report = PacedReplay(spark, cfg, f"{tmp_path}/seg", f"{tmp_path}/work").play(stopper)
    assert report.trade <= 1


def test_a_batch_that_runs_again_covers_the_same_rows(spark, tmp_path):
    cfg = config.parse_config({"realtime": 1, "replays": [entry(quotes(tmp_path / "q"), "b")]})
    paced = PacedReplay(spark, cfg, f"{tmp_path}/seg", f"{tmp_path}/work")
    assert not paced.deliver(0, 60 * MS)
    assert not paced.deliver(0, 10**12)  # the journal holds
    assert slots(paced.segments, "b")[19].bid_px == 6884
    assert paced.deliver(1, 10**12) and int(slots(paced.segments, "b")[19].update_id) == 101
