import random

import pytest
from pyspark.sql import functions as F

from tickloom.errors import Error, ReplayError
from tickloom.sources import csv_ticks, discover, jsonl_ticks
from tickloom.sources.lines import read_lines


def reference_split(line):
    """Character by character: a quote opens a field only as its first character."""
    out, i, n = [], 0, len(line)
    while True:
        field = ""
        if i < n and line[i] == '"':
            i += 1
            while i < n:
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        field, i = field + '"', i + 2
                        continue
                    i += 1
                    break
                field, i = field + line[i], i + 1
            while i < n and line[i] != ",":
                i += 1
        else:
            while i < n and line[i] != ",":
                field, i = field + line[i], i + 1
        out.append(field)
        if i < n:
            i += 1
            continue
        return out


def test_tokenizer(spark):
    r = random.Random(1)
    lines = ["", ",", "a", 'a,"b,c",d', '"x"z,y', '"a""b"', '"""', '"open,rest', 'a"b,c"d', '"",""', ',"', '" "x,', '"' + "q" * 20000 + '""' * 5000 + '",z']
    lines += ["".join(r.choice('a",\t é') for _ in range(r.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    got = [x.t for x in df.select("i", csv_ticks.tokenize(F.col("x")).alias("t")).orderBy("i").collect()]
    assert got == [reference_split(x) for x in lines] == [csv_ticks.split_line(x) for x in lines]


def test_headers():
    c = csv_ticks.resolve("symbol, ts ,extra,qty,px,side,ts\r", "trade")
    assert (c.count, c.ts, c.symbol, c.side, c.px, c.qty) == (7, 1, 0, 5, 4, 3)
    level = lambda ks: "".join(f",bid_px{k},bid_qty{k},ask_px{k},ask_qty{k}" for k in ks)
    assert len(csv_ticks.resolve("ts,symbol,update_id" + level(["", "_1", "_2", "_3", "_4"]), "book").levels) == 5
    for header, code in ((None, Error.CSV_SCHEMA), ("ts,symbol", Error.CSV_SCHEMA), ("﻿ts,symbol,side,px,qty", Error.CSV_SCHEMA)):
        with pytest.raises(ReplayError) as e:
            csv_ticks.resolve(header, "trade")
        assert e.value.code is code
    for bad, code in ((level(["", "_1", "_2"]), Error.BOOK_DEPTH_UNSUPPORTED), (level([""]) + ",bid_px_1,bid_px_2,bid_px_3,bid_px_4", Error.CSV_SCHEMA)):
        with pytest.raises(ReplayError) as e:
            csv_ticks.resolve("ts,symbol,update_id" + bad, "book")
        assert e.value.code is code


def put(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_bytes(text.encode())
    return str(folder)


def test_discovery(spark, tmp_path):
    d = put(tmp_path, b__book__csv="", a__book__csv="", x__trade__csv="", y__book__csvx="")
    (tmp_path / "z.book.csv").mkdir()
    assert [p.rsplit("/", 1)[1] for p in discover.discover(spark, d, "book", "csv")] == ["a.book.csv", "b.book.csv"]
    assert discover.discover(spark, d + "/nothing", "book", "csv") == [] and discover.detect_format(spark, d, "book") == "csv"
    put(tmp_path, c__book__json="")
    for kind in ("book",):
        with pytest.raises(ReplayError):
            discover.detect_format(spark, d, kind)
    (tmp_path / "e").mkdir()
    with pytest.raises(ReplayError):
        discover.detect_format(spark, d + "/e", "trade")
    put(tmp_path / "e", q__trade__json="{}")
    assert discover.detect_format(spark, d + "/e", "trade") == "json"


def test_lines_of_split_files(spark, tmp_path):
    texts = ["\n".join(f"{k}:{i}" + "x" * (i % 90) for i in range(4000)) + "\n" * (k == 1) for k in range(3)]
    for k, t in enumerate(texts):
        (tmp_path / f"f {k}+%41.txt").write_text(t)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = read_lines(spark, [(0, k, f"{tmp_path}/f {k}+%41.txt") for k in range(3)]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((x.src, x.row_no, x.value) for x in got) == [(k, i, v) for k in range(3) for i, v in enumerate(texts[k].removesuffix("\n").split("\n"))]


def rows(df):
    return df.orderBy("row_no").collect()


def read(spark, tmp_path, text, kind, name="s"):
    (tmp_path / f"{name}.{kind}.csv").write_bytes(text.encode())
    path = f"{tmp_path}/{name}.{kind}.csv"
    return csv_ticks.read_csv(spark, [(0, 0, path, csv_ticks.resolve(discover.first_line(spark, path), kind))], kind)


def test_csv_trades(spark, tmp_path):
    text = 'ts,symbol,side,px,qty\r\n100,"SOLUSDT",0,"68.84","1906.67"\r\n\r\n300,SOLUSDT,1,69\nabc,SOLUSDT,0,1,1\n5,SOLUSDT,7,1,1\n5,SOLUSDT,x,1,1\n5,SOLUSDT,1,6x.8,1\n5,BADSYM,1,1,1\n5,SOLUSDT,1,1,5000000000\n 5,SOLUSDT,1,1,1\n5,BADSYM,9,x,x'
    got = rows(read(spark, tmp_path, text, "trade"))
    assert [x.reason for x in got] == [None, "malformed", "bad_ts", "bad_field", "bad_field", "bad_number", "unknown_symbol", "scale_overflow", "bad_ts", "bad_field"]
    assert (got[0].ts_ns, got[0].gid, got[0].px, got[0].price_scale, got[0].qty, got[0].qty_scale) == (100, 19, 6884, 2, 190667, 2)


def test_csv_books(spark, tmp_path):
    names = ["", *(f"_{k}" for k in range(1, 5))]
    header = "ts,symbol,update_id," + ",".join(f"bid_px{s},bid_qty{s},ask_px{s},ask_qty{s}" for s in names)
    line = lambda ts, uid, last="68.9": f"{ts},SOLUSDT,{uid}," + ",".join(f"68.{84 - k},1{k},{last if k == 4 else f'68.{85 + k}'},2{k}.5" for k in range(5))
    got = rows(read(spark, tmp_path, "\n".join([header, line(1, 200), line(2, 18446744073709551615), line(3, -1), line(4, 9, "9x"), "2000,BADSYM,556" + ",1" * 20]), "book"))
    assert [x.reason for x in got] == [None, None, "bad_field", "bad_number", "unknown_symbol"]
    assert got[0].depth == 5 and got[0].bid_px[:6] == [6884, 6883, 6882, 6881, 6880, 0] and len(got[0].bid_px) == 25 and got[0].ask_px[4] == 6890 and got[0].price_scale == 2
    assert got[0].bid_qty[:5] == [100, 110, 120, 130, 140] and got[0].ask_qty[4] == 245 and got[0].qty_scale == 1 and int(got[1].update_id) == 2**64 - 1


def test_degenerate_files(spark, tmp_path):
    assert read(spark, tmp_path, "ts,symbol,side,px,qty\n", "trade").count() == 0
    (tmp_path / "empty.trade.csv").write_text("")
    good, bad = csv_ticks.usable(spark, [f"{tmp_path}/s.trade.csv", f"{tmp_path}/empty.trade.csv", f"{tmp_path}/gone.trade.csv"], "trade")
    assert [p.rsplit("/", 1)[1] for p, _ in good] == ["s.trade.csv"] and [e.code for _, e in bad] == [Error.CSV_SCHEMA, Error.FILE_OPEN]


def json_rows(spark, lines, read):
    return rows(read(spark, spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "row_no long, value string")))


def test_json_trades(spark):
    ok = '{"ts": 7, "symbol": "SOLUSDT", "side": 1, "px": "68.85", "qty": "0.125"}'
    cases = {ok: None, ok.replace("7", '"7"'): "bad_field", ok.replace("7", "true"): "bad_field", ok.replace("7", "1.9"): None, ok.replace('"68.85"', "68.85"): "bad_field", ok.replace('"side": 1', '"side": 3'): "bad_field",
             ok.replace("SOL", "BAD"): "unknown_symbol", ok.replace("68.85", "6x"): "bad_number", ok.replace("0.125", "5000000000"): "scale_overflow", ok[:-1]: "malformed", "[1]": "malformed", "7": "malformed", "null": "malformed",
             '{"ts": 1}': "bad_field", ok.replace('"ts": 7', '"ts": 5, "ts": 7'): None, ok.replace('"ts": 7', '"ts": 123456789012345678901234567890'): "bad_field", ok.replace('"side": 1', '"side": null'): "bad_field"}
    got = json_rows(spark, list(cases), jsonl_ticks.json_trades)
    assert [x.reason for x in got] == list(cases.values())
    assert (got[0].ts_ns, got[0].px, got[0].qty, got[0].qty_scale) == (7, 6885, 125, 3) and got[3].ts_ns == 1 and got[14].ts_ns == 7


def test_json_books(spark):
    level = lambda ks: "".join(f', "bid_px{k}": "68.84", "bid_qty{k}": "1", "ask_px{k}": "68.9", "ask_qty{k}": "2.5"' for k in ks)
    book = lambda uid, ks: f'{{"ts": 1, "symbol": "SOLUSDT", "update_id": {uid}{level(ks)}}}'
    five = ["", "_1", "_2", "_3", "_4"]
    cases = [(book(11, five), None), (book('"12"', [""]), None), (book(13, five[:3]), "bad_field"), (book('"x"', [""]), "bad_field"), (book(-1, [""]), "bad_field"), (book(18446744073709551615, [""]), None),
             (book("true", [""]), "bad_field"), (book(1, [""]).replace('"68.84"', "68.84"), "bad_field"), (book(1, [""]).replace("SOL", "X"), "unknown_symbol"), (book(1, []), "bad_field"), (book(1, ["", "_60"]), None), ("x", "malformed")]
    got = json_rows(spark, [c for c, _ in cases], jsonl_ticks.json_books)
    assert [x.reason for x in got] == [w for _, w in cases]
    assert (got[0].depth, int(got[0].update_id), got[0].ask_px[:6]) == (5, 11, [6890] * 5 + [0]) and (got[1].depth, int(got[1].update_id)) == (1, 12) and int(got[5].update_id) == 2**64 - 1
