import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import depth, fixed, times
from tickloom.functions.schema_hash import LAYOUTS, schema_fnv
from tickloom.functions.symbols import SYMBOLS, gid_of, to_gid

U32 = fixed.U32_MAX


def decimals(v):
    return len(v.split(".", 1)[1].rstrip("0")) if "." in v else 0


def mantissa(v, s):
    if not v or v[0] == "-":
        return None
    whole, _, frac = v.partition(".")
    digits = (whole or "0") + frac[:s].ljust(s, "0")
    return int(digits) if digits.isascii() and digits.isdigit() else None


def encode(values):
    for s in range(max(map(decimals, values), default=0), -1, -1):
        out = []
        for v in values:
            m = mantissa(v, s)
            if m is None:
                return "bad_number", None, None
            if m > U32:
                break
            out.append(m)
        else:
            return "ok", s, out
    return "scale_overflow", None, None


def run(spark, groups):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "i int, g array<string>").select("i", fixed.encode_group(F.col("g")).alias("e"))
    return [(r.e.status, r.e.scale, r.e.mantissas) for r in df.orderBy("i").collect()]


def test_encoding_fixtures(spark):
    groups = [["68.8", "68.85"], ["68.8400"], ["69"], ["0.00012345"], ["68000.12345678"], ["6a.5"], ["-1.0"], ["99999999999999999999999"]]
    want = [("ok", 2, [6880, 6885]), ("ok", 2, [6884]), ("ok", 0, [69]), ("ok", 8, [12345]), ("ok", 4, [680001234]), ("bad_number", None, None), ("bad_number", None, None), ("scale_overflow", None, None)]
    assert run(spark, groups) == want == [encode(g) for g in groups]


def test_first_bad_element_decides(spark):
    groups = [["5000000000", "abc"], ["abc", "5000000000"], ["68000.12345678", "1.1234567x"], ["."], ["5."], [".5"], ["+1"], ["1e5"], [" 1"], [""], ["1\n"], [], ["00000000000000000001.50"], ["1.2.3"], ["1", None]]
    got = run(spark, groups)
    assert got[:-1] == [encode(g) for g in groups[:-1]] and got[-1][0] == "bad_number"
    assert got[0][0] == "scale_overflow" and got[1][0] == "bad_number" and got[2] == ("ok", 4, [680001234, 11234])


def test_encoding_at_random(spark):
    r = random.Random(7)
    piece = lambda: r.choice(["", "0", "1", "42", "4294967295", "4294967296", "68000", "x", "-", "00", str(r.randrange(10**r.randint(1, 12)))])
    value = lambda: piece() + r.choice(["", ".", "." + piece(), "." + piece() + r.choice(["0", "00", "x", ""])])
    groups = [[value() for _ in range(r.randint(1, 4))] for _ in range(3000)]
    assert run(spark, groups) == [encode(g) for g in groups]


def test_decimals_and_text(spark):
    df = spark.createDataFrame([("1.230",), ("5",), ("0.001",)], "t string")
    assert [r[0] for r in df.select(fixed.decimals_of(F.col("t"))).collect()] == [2, 0, 3]
    df = spark.createDataFrame([(6884, 2, "68.84"), (5, 0, "5"), (5, 3, "0.005"), (0, 2, "0.00"), (U32, 8, "42.94967295"), (123, 3, "0.123")], "m long, s int, want string")
    assert all(r.got == r.want for r in df.select(fixed.to_decimal(F.col("m"), F.col("s")).alias("got"), "want").collect())


def test_strict_integers(spark):
    texts = ["12", "-12", " 12", "12 ", "+12", "", "1x", "9223372036854775807", "9223372036854775808", "18446744073709551615", "18446744073709551616", "00000000000000000000000000007", "-0", "1\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [(r.a, r.b) for r in df.select("i", fixed.to_i64(F.col("t")).alias("a"), fixed.to_u64(F.col("t")).cast("string").alias("b")).orderBy("i").collect()]
    assert got == [(12, "12"), (-12, None), (None, None), (None, None), (None, None), (None, None), (None, None), (2**63 - 1, str(2**63 - 1)), (None, str(2**63)), (None, str(2**64 - 1)), (None, None), (7, "7"), (0, None), (None, None), (None, None)]


def test_symbols(spark):
    assert len(SYMBOLS) == 27 and SYMBOLS[19] == "SOLUSDT" and SYMBOLS[7] == "BNBUSDT"
    df = spark.createDataFrame([("SOLUSDT", 19), ("solusdt", None), ("BADSYM", None), (None, None)], "s string, want int")
    assert all(r.g == r.want for r in df.select(gid_of(F.col("s")).alias("g"), "want").collect())
    assert [r[0] for r in spark.range(-1, 28).select(to_gid(F.col("id"))).collect()] == [-1, *range(27), -1]


@pytest.mark.parametrize("levels,want", [([], 1), (range(1, 5), 5), (range(1, 10), 10), (range(1, 15), 15), (range(1, 20), 20), (range(1, 25), 25), ([1, 2], None), (range(1, 6), None), (range(1, 26), None), ([1, 3, 4], None), ([1, 5], None), ([60], 1), ([*range(1, 5), 52], None), ([*range(1, 5), 53], 5)])
def test_depth(spark, levels, want):
    levels = list(levels)
    assert depth.book_depth(lambda k: k in levels) == want
    df = spark.createDataFrame([(levels + levels,)], "l array<int>")
    got = df.select(depth.book_depth_column(F.col("l")), depth.highest_level_column(F.col("l"))).first()
    assert tuple(got) == (want, max(levels, default=0)) and depth.highest_level(lambda k: k in levels) == max(levels, default=0)


def test_clock(spark):
    at = lambda ts, ts0, rt: spark.range(1).select(times.offset_ns(F.lit(ts), ts0, rt)).first()[0]
    assert [at(2000, 1000, 1), at(5000, 1000, 1), at(1000, 0, 0.5), at(1000, 1000, 1), at(3000, 1000, 1), at(500, 1000, 1), at(500, None, 1), at(9, 0, 0)] == [1000, 4000, 500, 0, 2000, 0, 0, 0]
    assert times.init_delay_s(3_000_000_000, 1_000_000_000, 0.5) == 1.0 and times.init_delay_s(1, 2, 1) < 0


def test_datetimes():
    ns = 10**9
    assert times.parse_datetime_ns("2026-06-23 09:00:00", 0) == times.parse_datetime_ns("2026-6-23 9:0:0", 0) == 1782205200 * ns
    assert times.parse_datetime_ns("", -5) == -5
    for bad in ("2026-02-30 00:00:00", "2026-06-23", "2026-06-23 09:00:00x", "2026-06-23 09:00:00 ", "x", "2026-13-01 00:00:00", "2026-06-23 24:00:00", "1969-12-31 23:59:59"):
        assert times.parse_datetime_ns(bad, 0) is None
    assert times.parse_ts_value("123") == 123 and times.parse_ts_value("") is None and times.parse_ts_value("1970-01-01 00:00:01") == ns and times.parse_ts_value("1x") is None


def test_layout_hashes():

    assert [f"{schema_fnv(x):x}" for x in (LAYOUTS["bbo"], LAYOUTS["depth"], LAYOUTS["trade"])] == ["c0820a5fb350b598", "74b01e065bf4c589", "1ed29fc435a25cc3"]
