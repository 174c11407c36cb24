"""Named queries that go the way of a user's data: tick files are written from the driver's tables, found, read, merged and
played into segments, and the segments are read back. With them, the SQL that gives the same rows."""

from __future__ import annotations

import tomllib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import REASONS, ReplayError
from ..functions import times
from ..functions.schema_hash import LAYOUTS, schema_fnv
from ..operators import boards, merge, rejects
from ..operators.scans import position
from ..operators.segments import HEADERS, Segments, segment_bytes
from ..operators.stored import new_folder
from ..sources.csv_ticks import read_csv, usable
from ..sources.discover import detect_format, discover
from ..sources.jsonl_ticks import read_json
from ..streaming.paced import PacedReplay
from . import replay
from .config import LEVELS, Config, Input, Output, Replay, overridden, parse_config
from .sql import END, FRAC, GOOD, MID, SPOILED, START, TICKS, frac_length, with_
from .ticks import chunk_of_rows, spoiled, ticks

BOOK_FIELDS = ["bid_px", "bid_qty", "ask_px", "ask_qty"]


def tick_files(lines: DataFrame, folder: str, ending: str) -> str:
    """A file for each src of lines (src, row_no, value), in row order; names sort as sources do. Returns the folder."""
    spark = lines.sparkSession
    lines.repartition("src").sortWithinPartitions("src", "row_no").select("src", "value").write.partitionBy("src").text(f"{folder}.parts")
    path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    for made in store.listStatus(path(f"{folder}.parts")):
        name = made.getPath().getName()
        if name.startswith("src="):
            parts = [f.getPath() for f in store.listStatus(made.getPath()) if f.getPath().getName().startswith("part-")]
            store.rename(parts[0], path(f"{folder}/s{int(name[4:]):03d}{ending}"))
    store.delete(path(f"{folder}.parts"), True)
    return folder


def _headed(rows: DataFrame, header: Column) -> DataFrame:
    """Lines of rows (src, row_no, value) with a header line before each source's first, and an empty line behind it."""
    tops = rows.select("src").distinct().select("src", F.explode(F.array(F.struct(F.lit(-2).cast("bigint").alias("row_no"), header.alias("value")), F.struct(F.lit(-1).cast("bigint").alias("row_no"), F.lit("").alias("value")))).alias("h"))
    return rows.unionByName(tops.select("src", "h.row_no", "h.value"))


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades in two layouts: even sources quote prices and end lines with CR LF, odd ones have other columns in another order.
    One row in 53 is a field short."""
    rows, n, even = spoiled(ticks(spark, sf_dir)), F.col("row_no"), F.col("src") % 2 == 0
    quoted = F.concat(F.lit('"'), "px", F.lit('"'))
    first = F.when(n % 53 == 0, F.concat_ws(",", "ts", "symbol", "side", quoted)).otherwise(F.concat_ws(",", "ts", "symbol", "side", quoted, "qty"))
    other = [F.col("qty"), F.lit('"a,""b"'), F.col("px"), F.col("side"), F.col("symbol"), F.col("ts")]
    second = F.when(n % 53 == 0, F.concat_ws(",", *other)).otherwise(F.concat_ws(",", *other, F.lit("999")))  # of two qty columns the first counts
    value = F.when(even, F.concat(first, F.lit("\r"))).otherwise(second)
    return _headed(rows.select("src", "row_no", value.alias("value")), F.when(even, F.lit("ts,symbol,side,px,qty\r")).otherwise(F.lit(" qty ,extra,\tpx,side,symbol,ts,qty")))


def _sized_books(rows: DataFrame) -> DataFrame:
    """rows with functions of a level's number for prices and quantities: whole numbers about px, one fraction for all."""
    return rows.withColumns({"whole": F.split_part("px", F.lit("."), F.lit(1)).cast("bigint"), "part": F.lpad((F.col("row_no") % 100).cast("string"), 2, "0"), "lot": 1 + F.col("row_no") % 7})


def _price(whole: Column) -> Column:
    return F.concat(whole.cast("string"), F.lit("."), F.col("part"))


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV books of 1, 5 or 25 levels, by source."""
    n = F.col("row_no")

    def fields(depth: int) -> Column:
        one = lambda k: F.array(
            _price(F.col("whole") + 100 - k), F.when((n % 57 == 0) & (k == 0), "5000000000").otherwise(((k + 1) * F.col("lot")).cast("string")),
            F.when((n % 61 == 0) & (k == depth - 1), "9x").otherwise(_price(F.col("whole") + 101 + k)), ((k + 2) * F.col("lot")).cast("string"),
        )
        start = F.array(F.when(n % 71 == 0, "abc").otherwise(F.col("ts_ns").cast("string")), F.col("symbol"), F.when(n % 67 == 0, "x").otherwise(F.col("update_id").cast("string")))
        return F.concat(start, F.flatten(F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), one)))

    def header(depth: int) -> Column:
        return F.lit(",".join(["ts", "symbol", "update_id", *(f + (f"_{k}" if k else "") for k in range(depth) for f in BOOK_FIELDS)]))

    of = lambda make: F.when(F.col("src") % 3 == 0, make(1)).when(F.col("src") % 3 == 1, make(5)).otherwise(make(25))
    rows = _sized_books(ticks(spark, sf_dir)).withColumn("f", of(fields))
    value = F.array_join(F.when(n % 59 == 0, F.slice("f", F.lit(1), F.size("f") - 1)).otherwise(F.col("f")), ",")
    return _headed(rows.select("src", "row_no", value.alias("value")), of(header))


def json_book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON books, each row of a depth of its own (1, 5 or 10); ids are numbers or text."""
    n = F.col("row_no")
    depth = F.get(F.array(F.lit(1), F.lit(5), F.lit(10)), (n % 3).cast("int"))
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def level(k: Column) -> Column:
        suffix = F.when(k == 0, "").otherwise(F.concat(F.lit("_"), k.cast("string")))
        key = lambda f, v: F.concat(F.lit(f', "{f}'), suffix, F.lit('": '), v)
        ask = _price(F.col("whole") + 101 + k)
        return F.concat(
            key("bid_px", text(F.when((n % 57 == 0) & (k == 0), "9x").otherwise(_price(F.col("whole") + 100 - k)))), key("bid_qty", text(((k + 1) * F.col("lot")).cast("string"))),
            key("ask_px", F.when((n % 61 == 0) & (k == depth - 1), ask).otherwise(text(ask))), key("ask_qty", text(((k + 2) * F.col("lot")).cast("string"))),
        )

    ts, uid = F.col("ts_ns").cast("string"), F.col("update_id").cast("string")
    value = F.concat(
        F.lit('{"ts": '), F.when(n % 71 == 0, text(ts)).otherwise(ts), F.lit(', "symbol": '), text(F.col("symbol")), F.lit(', "update_id": '), F.when(n % 67 == 0, "-5").when(n % 2 == 0, text(uid)).otherwise(uid),
        F.array_join(F.transform(F.sequence(F.lit(0), depth - 1), level), ""), F.when(n % 53 == 0, ', "bid_px_30": "1"').otherwise(""), F.lit("}"),
    )
    return _sized_books(ticks(spark, sf_dir)).select("src", "row_no", F.when(n % 59 == 0, "[1, 2]").otherwise(value).alias("value"))


def _read(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    form = detect_format(spark, folder, kind)
    paths = discover(spark, folder, kind, form)
    if form == "json":
        return read_json(spark, [(0, i, p) for i, p in enumerate(paths)], kind)
    good, _ = usable(spark, paths, kind)
    return read_csv(spark, [(0, i, p, c) for i, (p, c) in enumerate(good)], kind)


def _if_good(**columns: Column) -> list[Column]:
    return [F.when(F.col("reason").isNull(), c).alias(name) for name, c in columns.items()]


def csv_trades_file(spark, sf_dir):
    """Every row of trade files in two layouts, with its line, reason and values."""
    rows = _read(spark, tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv"), "trade")
    return rows.select("src", "row_no", "reason", *_if_good(**{c: F.col(c) for c in ("ts_ns", "gid", "side", "px", "qty", "price_scale", "qty_scale")}))


def csv_merge_order(spark, sf_dir):
    """Places of the valid rows of those files in the one order of all sources."""
    rows = _read(spark, tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv"), "trade").where("reason IS NULL")
    return position(merge.emitted(rows, {0: (START, END)}, chunk_of_rows()), [], merge.ORDER, "place").select("src", "row_no", "merge_ts", "place")


def _shown_books(rows: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(F.transform(F.slice(c, F.lit(1), F.col("depth")), lambda x: x.cast("string")), ",")
    values = {"update_id": F.col("update_id").cast("string"), **{c: F.col(c) for c in ("ts_ns", "lid", "depth", "price_scale", "qty_scale")}, **{c: joined(c) for c in BOOK_FIELDS}}
    return rows.select("src", "row_no", "reason", *_if_good(**values))


def csv_books_file(spark, sf_dir):
    """Every row of book files of three depths, with all its levels."""
    return _shown_books(_read(spark, tick_files(book_lines(spark, sf_dir), new_folder(spark, "books"), ".book.csv"), "book"))


def json_books_file(spark, sf_dir):
    """Every row of JSON book files whose rows have depths of their own."""
    return _shown_books(_read(spark, tick_files(json_book_lines(spark, sf_dir), new_folder(spark, "books"), ".book.json"), "book"))


def top_of_book_cut(spark, sf_dir):
    """The first level of books of 25, in a table of one level."""
    rows = _read(spark, tick_files(book_lines(spark, sf_dir).where("src % 3 = 2"), new_folder(spark, "books"), ".book.csv"), "book").where("reason IS NULL")
    rows = rows.withColumn("src", 3 * F.col("src") + 2)  # files of the other sources aren't there
    won = boards.board(boards.claim(boards.top_of_book(merge.emitted(rows, {}, chunk_of_rows())), ["lid"]), [*BOOK_FIELDS, "price_scale"], ["lid"])
    return won.select("lid", "seq", F.col("update_id").cast("bigint").alias("update_id"), *BOOK_FIELDS, "price_scale")


def _plan(kind: str, folder: str, name: str, create: bool = True, start: int = times.NO_START, end: int = times.NO_END, form: str = "auto") -> Replay:
    return Replay(Input(form, folder, kind), Output(name, create), start, end)


def _played(spark: SparkSession, *plans: Replay) -> Segments:
    root = new_folder(spark, "segments")
    replay.run(spark, Config(realtime=0.0, replays=plans), root)
    return Segments(spark, root)


def _bbo(segments: Segments, name: str) -> DataFrame:
    return segments.read(name).select("lid", "seq", "exch_ns", F.col("update_id").cast("bigint").alias("update_id"), *BOOK_FIELDS, "price_scale", F.col("best_uid").cast("bigint").alias("best_uid"))


def _books_of(spark: SparkSession, sf_dir: str, third: int) -> str:
    return tick_files(book_lines(spark, sf_dir).where(f"src % 3 = {third}"), new_folder(spark, "books"), ".book.csv")


def segment_bbo(spark, sf_dir):
    """A replay of one-level files under a window into a new board, read back."""
    return _bbo(_played(spark, _plan("book", _books_of(spark, sf_dir, 0), "bbo", start=START, end=END)), "bbo")


def segment_reattach(spark, sf_dir):
    """A replay up to a time, and one of everything onto the same board."""
    folder = _books_of(spark, sf_dir, 0)
    segments = _played(spark, _plan("book", folder, "bbo", end=MID))
    replay.run(spark, Config(realtime=0.0, replays=(_plan("book", folder, "bbo", create=False),)), segments.root)
    return _bbo(segments, "bbo")


def segment_depth(spark, sf_dir):
    """A replay of 25-level files into a board of all levels, read back."""
    rows = _played(spark, _plan("book", _books_of(spark, sf_dir, 2), "deep")).read("deep")
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return rows.select("lid", "seq", F.col("update_id").cast("bigint").alias("update_id"), "depth", "price_scale", "qty_scale", *map(joined, BOOK_FIELDS))


def segment_trades(spark, sf_dir):
    """A replay of trade files into a log, read back."""
    folder = tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv")
    rows = _played(spark, _plan("trade", folder, "log", start=START)).read("log")
    return rows.select("slot", "ring_idx", "seq", "exch_ns", "px", "qty", "gid", "side", "price_scale", "qty_scale")


def segment_drain(spark, sf_dir):
    """What a reader at slot 10 of that log gets, and how many trades passed it by."""
    folder = tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv")
    got, lapped, after = _played(spark, _plan("trade", folder, "log", start=START)).drain("log", 10)
    return got.agg(F.count(F.lit(1)).alias("delivered"), F.min("slot").alias("first_slot"), F.sum("qty").alias("qty")).withColumns({"lapped": F.lit(lapped).cast("long"), "next_slot": F.lit(after).cast("long")})


def paced_trades(spark, sf_dir):
    """The same log from a replay at a pace: a month in a quarter of a second."""
    folder = tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv")
    cfg = Config(realtime=1e-7, replays=(_plan("trade", folder, "log", start=START),), progress_sec=0)
    player = PacedReplay(spark, cfg, new_folder(spark, "segments"), new_folder(spark, "paced"))
    player.play()
    return player.segments.read("log").select("slot", "ring_idx", "seq", "exch_ns", "px", "qty", "gid", "side")


def replay_report(spark, sf_dir):
    """Counts of a replay of two units, one of whose outputs can't be written."""
    root = new_folder(spark, "segments")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/blocked")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()  # a file where a folder has to be
    books, trades = _books_of(spark, sf_dir, 0), tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv")
    got = replay.run(spark, Config(realtime=0.0, replays=(_plan("book", books, "bbo", end=END), _plan("trade", trades, "blocked"))), root)
    counts = [("quotes", got.book), ("trades", got.trade), ("stale", got.deduped[0]), ("not written", got.failed[1]), ("last", got.last_ns), *got.skipped.items()]
    return spark.createDataFrame([(k, int(v)) for k, v in counts], "what string, n bigint")


def summary_lines(spark, sf_dir):
    """The lines that a log shows about rejected trades."""
    rows = _read(spark, tick_files(trade_lines(spark, sf_dir), new_folder(spark, "trades"), ".trade.csv"), "trade")
    counts = {r.reason: r.rows for r in rejects.skip_counts(rows).collect()}
    names = [r.symbol for r in rejects.unknown_symbols(rows).collect()]
    return spark.createDataFrame(list(enumerate(rejects.summary(counts, names))), "line int, text string")


def found_files(spark, sf_dir):
    """What a folder with good and bad files, other files and a folder is read as."""
    folder = tick_files(trade_lines(spark, sf_dir).where("src < 2"), new_folder(spark, "mixed"), ".trade.csv")
    path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    store = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in (("empty.trade.csv", ""), ("header.trade.csv", "ts,symbol,side,px,qty\n"), ("lacking.trade.csv", "ts,symbol,px,qty\n1,SOLUSDT,1,1\n"), ("other.book.csv", "ts\n"), ("x.trade.csv.bak", "ts\n"), ("A.trade.csv", "ts,symbol,side,px,qty")):
        stream = store.create(path(f"{folder}/{name}"))
        stream.write(bytearray(text.encode()))
        stream.close()
    store.mkdirs(path(f"{folder}/folder.trade.csv"))
    paths = discover(spark, folder, "trade", "csv")
    good, bad = usable(spark, paths, "trade")
    state = {p: "ok" for p, _ in good} | {p: e.code.name for p, e in bad}
    rows = _read(spark, folder, "trade").groupBy("src").agg(F.count(F.lit(1)).alias("rows"))
    listed = spark.createDataFrame([(i, p.rsplit("/", 1)[1], state[p], next((k for k, (q, _) in enumerate(good) if q == p), None)) for i, p in enumerate(paths)], "place int, file string, state string, src int")
    return listed.join(rows, "src", "left").select("place", "file", "state", "src", F.coalesce("rows", F.lit(0)).alias("rows"))


def unit_errors(spark, sf_dir):
    """Why units can't be loaded: sources of different depths, no files, files of both formats."""
    mixed = tick_files(book_lines(spark, sf_dir).where("row_no < 400"), new_folder(spark, "books"), ".book.csv")
    both = tick_files(book_lines(spark, sf_dir).where("row_no < 400 AND src = 0"), tick_files(json_book_lines(spark, sf_dir).where("row_no < 400 AND src = 0"), new_folder(spark, "books"), ".book.json"), ".book.csv")
    out = []
    for name, folder, form in (("depths", mixed, "auto"), ("none", new_folder(spark, "nothing"), "csv"), ("neither", new_folder(spark, "nothing"), "auto"), ("both", both, "auto"), ("csv of both", both, "csv")):
        try:
            unit = replay.load_unit(spark, 0, _plan("book", folder, "x", form=form), 0)
            out.append((name, f"depth {unit.depth}"))
        except ReplayError as e:
            out.append((name, e.code.name))
    return spark.createDataFrame(out, "unit string, state string")


def unknown_sample_cap(spark, sf_dir):
    """Of more than 64 unknown names, the first 64 in reading order."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = items.select(F.lit(0).alias("src"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_no"), F.concat(F.lit("P"), (F.col("l_partkey") % 1000).cast("string")).alias("symbol"), F.lit("unknown_symbol").alias("reason"))
    return rejects.unknown_symbols(rows)


def parse_datetimes(spark, sf_dir):
    """Times written in ways that do and don't count, as nanoseconds."""
    n = F.col("o_orderkey")
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + n % 86400)
    text = F.when(n % 7 == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).when(n % 7 == 1, F.date_format(at, "yyyy-M-d H:m:s")).when(n % 7 == 2, F.date_format(at, "yyyy-MM-dd HH:mm:ss'Z'")).when(n % 7 == 3, F.date_format(at, "yyyy-'02-30' HH:mm:ss"))
    text = text.when(n % 7 == 4, F.date_format(at, "yyyy-MM-dd")).when(n % 7 == 5, (F.unix_seconds(at) * 1_000_000_000).cast("string")).otherwise(F.lit(""))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(n, times.datetime_ns(text).alias("datetime_ns"), times.ts_value_ns(text).alias("value_ns"))


def clock_from_init(spark, sf_dir):
    """When rows are due if the clock starts at a given time, of which some rows are before, and after how many seconds the
    first is."""
    rows = merge.emitted(ticks(spark, sf_dir), {0: (START, END), 1: (START, END)}, chunk_of_rows())
    first = rows.agg(F.min("merge_ts")).first()[0]
    return rows.select("row_no", times.offset_ns(F.col("ts_ns"), MID, 0.25).alias("offset_ns"), F.lit(int(times.init_delay_s(first, MID, 0.5))).cast("long").alias("delay_s"))


def segment_layouts(spark, sf_dir):
    """What segments are by their headers."""
    rows = [(name, HEADERS[name].kind, HEADERS[name].entry_size, HEADERS[name].capacity, f"{schema_fnv(text):016x}", segment_bytes(name)) for name, text in LAYOUTS.items()]
    return spark.createDataFrame(rows, "layout string, kind int, entry_size int, capacity int, hash string, bytes int")


_JOB = """
realtime = 0.5
init_ts = "2024-01-05 00:00:00"
[[replays]]
input = { dir = "/ticks" }
output = { path = "bbo" }
end = "2024-1-20 0:00:00"
[[replays]]
input = { dir = "/ticks", kind = "trade", format = "json" }
output = { path = "log", create = false }
start = "2024-01-05 00:00:00"
[log]
level = "warn"
"""


def config_settings(spark, sf_dir):
    """A job's settings, its defaults, and what a command line puts in their place."""
    cfg = parse_config(tomllib.loads(_JOB))
    over = overridden(cfg, realtime=0.0, init_ts="17", log_level="debug", progress_sec=-1)
    rows = [("realtime", str(cfg.realtime)), ("init_ts", str(cfg.init_ts)), ("level", str(LEVELS[cfg.log_level])), ("progress", str(cfg.progress_sec)), *((f"over.{k}", str(v)) for k, v in (("realtime", over.realtime), ("init_ts", over.init_ts), ("level", LEVELS[over.log_level]), ("progress", over.progress_sec)))]
    for i, r in enumerate(cfg.replays):
        rows += [(f"{i}.{k}", str(v)) for k, v in (("format", r.input.format), ("kind", r.input.kind), ("path", r.output.path), ("create", r.output.create), ("start", r.start_ns), ("end", r.end_ns))]
    return spark.createDataFrame(rows, "setting string, value string")


def config_errors(spark, sf_dir):
    """Jobs that are refused, and two that aren't."""
    good = {"input": {"dir": "/t"}, "output": {"path": "a"}}
    jobs = {
        "fast": {"realtime": 2.0, "replays": [good]}, "nan": {"realtime": float("nan"), "replays": [good]}, "no path": {"replays": [{"input": {"dir": "/t"}, "output": {}}]}, "no replays": {}, "no input": {"replays": [{"output": {"path": "a"}}]},
        "kind": {"replays": [{**good, "input": {"dir": "/t", "kind": "bar"}}]}, "format": {"replays": [{**good, "input": {"dir": "/t", "format": "parquet"}}]}, "same path": {"replays": [good, good]},
        "order": {"replays": [{**good, "start": "2024-01-02 00:00:00", "end": "2024-01-01 00:00:00"}]}, "datetime": {"replays": [{**good, "start": "2024-02-30 00:00:00"}]}, "equal": {"replays": [{**good, "start": "2024-01-01 00:00:00", "end": "2024-01-01 00:00:00"}]}, "auto": {"replays": [{**good, "input": {"dir": "/t", "format": "auto"}}]},
    }
    rows = []
    for name, job in jobs.items():
        try:
            parse_config(job)
            rows.append((name, "ok"))
        except ReplayError as e:
            rows.append((name, e.code.name))
    return spark.createDataFrame(rows, "job string, state string")


QUERIES = {
    f.__name__: f
    for f in (
        csv_trades_file, csv_merge_order, csv_books_file, json_books_file, top_of_book_cut, segment_bbo, segment_reattach, segment_depth, segment_trades, segment_drain, paced_trades, replay_report, summary_lines,
        found_files, unit_errors, unknown_sample_cap, parse_datetimes, clock_from_init, segment_layouts, config_settings, config_errors,
    )
}

_TRADES = SPOILED + """,
f AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY row_no) + 1 AS line, CASE WHEN row_no % 53 = 0 THEN 'malformed' ELSE reason END AS why FROM r)"""
_PX = f"TRY_CAST(split_part(spx, '.', 1) || {FRAC.format(v='spx')} AS BIGINT)"
_EMITTED = _TRADES + """,
v AS (SELECT *, max(ts_ns) OVER (PARTITION BY src ORDER BY line ROWS UNBOUNDED PRECEDING) AS merge_ts FROM f WHERE why IS NULL)"""
_LOG = _EMITTED + f""",
p AS (SELECT *, row_number() OVER (ORDER BY merge_ts, src, line) - 1 AS slot, count(*) OVER () AS head FROM v WHERE ts_ns >= {START})"""
_LOG_ROWS = f"slot, CAST(slot % 4096 AS INT) AS ring_idx, 2 * slot AS seq, ts_ns AS exch_ns, {_PX} AS px, CAST(sqty AS BIGINT) AS qty, gid, side"

#: b: books with the line in their file, reason, depth, and scale, factor and fraction of their prices.
_BOOKS = TICKS + """,
b AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY row_no) + 1 AS line, CAST([1, 5, 25][src % 3 + 1] AS INT) AS depth,
             CASE WHEN row_no % 59 = 0 THEN 'malformed' WHEN row_no % 71 = 0 THEN 'bad_ts' WHEN row_no % 67 = 0 THEN 'bad_field' WHEN gid >= 27 THEN 'unknown_symbol'
                  WHEN row_no % 61 = 0 THEN 'bad_number' WHEN row_no % 57 = 0 THEN 'scale_overflow' END AS reason FROM t)"""
_JSON = TICKS + """,
b AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY row_no) - 1 AS line, CAST([1, 5, 10][row_no % 3 + 1] AS INT) AS depth,
             CASE WHEN row_no % 59 = 0 THEN 'malformed' WHEN row_no % 71 = 0 OR row_no % 67 = 0 OR row_no % 53 = 0 OR row_no % 61 = 0 THEN 'bad_field' WHEN gid >= 27 THEN 'unknown_symbol'
                  WHEN row_no % 57 = 0 THEN 'bad_number' END AS reason FROM t)"""
_SCALED = """,
s AS (SELECT *, CASE WHEN row_no % 100 = 0 THEN 0 WHEN row_no % 10 = 0 THEN 1 ELSE 2 END AS scale, CAST(split_part(px, '.', 1) AS BIGINT) AS whole, 1 + row_no % 7 AS lot FROM b),
m AS (SELECT *, [1, 10, 100][scale + 1] AS pow, row_no % 100 * [1, 10, 100][scale + 1] // 100 AS frac FROM s)"""
_LEVELS = _SCALED + """,
k AS (SELECT row_no, string_agg(CAST((whole + 100 - k) * pow + frac AS VARCHAR), ',' ORDER BY k) AS bid_px, string_agg(CAST((k + 1) * lot AS VARCHAR), ',' ORDER BY k) AS bid_qty,
             string_agg(CAST((whole + 101 + k) * pow + frac AS VARCHAR), ',' ORDER BY k) AS ask_px, string_agg(CAST((k + 2) * lot AS VARCHAR), ',' ORDER BY k) AS ask_qty
      FROM (SELECT *, unnest(range(depth)) AS k FROM m WHERE reason IS NULL) GROUP BY row_no)"""
_SHOWN = """
SELECT src, line AS row_no, reason, CASE WHEN reason IS NULL THEN CAST(update_id AS VARCHAR) END AS update_id, CASE WHEN reason IS NULL THEN ts_ns END AS ts_ns, CASE WHEN reason IS NULL THEN gid END AS lid,
       CASE WHEN reason IS NULL THEN depth END AS depth, CASE WHEN reason IS NULL THEN scale END AS price_scale, CASE WHEN reason IS NULL THEN 0 END AS qty_scale, bid_px, bid_qty, ask_px, ask_qty
FROM m LEFT JOIN k USING (row_no)"""


def _claimed(third: int, where: str, floor: str = "") -> str:
    """e: emitted books of a third of the sources; c: those with accepted."""
    return f"""
v AS (SELECT *, max(ts_ns) OVER (PARTITION BY src ORDER BY line ROWS UNBOUNDED PRECEDING) AS merge_ts FROM m WHERE reason IS NULL AND src % 3 = {third}),
e AS (SELECT * FROM v WHERE {where}),
c AS (SELECT *, update_id > coalesce(max(update_id) OVER (PARTITION BY gid ORDER BY merge_ts, src, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS accepted FROM e)"""


_SLOTS = """
w AS (SELECT gid AS lid, 2 * count(*) AS seq, max(update_id) AS update_id, arg_max(row_no, update_id) AS row_no FROM a GROUP BY gid),
l AS (SELECT CAST(x AS INT) AS lid FROM (SELECT unnest(range(27)) AS x))
SELECT l.lid, coalesce(seq, 0) AS seq, coalesce(ts_ns, 0) AS exch_ns, coalesce(w.update_id, 0) AS update_id, coalesce((whole + 100) * pow + frac, 0) AS bid_px, coalesce(lot, 0) AS bid_qty,
       coalesce((whole + 101) * pow + frac, 0) AS ask_px, coalesce(2 * lot, 0) AS ask_qty, coalesce(scale, 0) AS price_scale, coalesce(w.update_id, 0) AS best_uid
FROM l LEFT JOIN w USING (lid) LEFT JOIN m ON m.row_no = w.row_no"""
_REASONS = ", ".join(f"({i}, '{r}')" for i, r in enumerate(REASONS))
_ZEROS = "0" + ",0" * 24


def _values(columns: str, rows: list[tuple]) -> str:
    quote = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) AS x({columns})"


SQL = {
    "csv_trades_file": with_(_TRADES, f"""
SELECT src, line AS row_no, why AS reason, CASE WHEN why IS NULL THEN ts_ns END AS ts_ns, CASE WHEN why IS NULL THEN gid END AS gid, CASE WHEN why IS NULL THEN side END AS side,
       CASE WHEN why IS NULL THEN {_PX} END AS px, CASE WHEN why IS NULL THEN TRY_CAST(sqty AS BIGINT) END AS qty, CASE WHEN why IS NULL THEN CAST({frac_length('spx')} AS INT) END AS price_scale,
       CASE WHEN why IS NULL THEN 0 END AS qty_scale FROM f"""),
    "csv_merge_order": with_(_EMITTED, f"""
SELECT src, line AS row_no, merge_ts, row_number() OVER (ORDER BY merge_ts, src, line) - 1 AS place FROM v WHERE ts_ns >= {START} AND merge_ts <= {END}"""),
    "csv_books_file": with_(_BOOKS + _LEVELS, _SHOWN),
    "json_books_file": with_(_JSON + _LEVELS, _SHOWN),
    "top_of_book_cut": with_(_BOOKS + _SCALED + "," + _claimed(2, "true"), """
, w AS (SELECT gid AS lid, 2 * count(*) AS seq, max(update_id) AS update_id, arg_max(row_no, update_id) AS row_no FROM c WHERE accepted GROUP BY gid)
SELECT lid, seq, w.update_id, (whole + 100) * pow + frac AS bid_px, lot AS bid_qty, (whole + 101) * pow + frac AS ask_px, 2 * lot AS ask_qty, scale AS price_scale FROM w JOIN m USING (row_no)"""),
    "segment_bbo": with_(_BOOKS + _SCALED + "," + _claimed(0, f"ts_ns >= {START} AND merge_ts <= {END}"), ", a AS (SELECT * FROM c WHERE accepted)," + _SLOTS),
    "segment_reattach": with_(_BOOKS + _SCALED + "," + _claimed(0, f"merge_ts <= {MID}"), """
, g AS (SELECT gid, max(update_id) AS floor FROM e GROUP BY gid),
d AS (SELECT v.*, update_id > greatest(coalesce(max(update_id) OVER (PARTITION BY v.gid ORDER BY merge_ts, src, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), coalesce(floor, 0)) AS accepted FROM v LEFT JOIN g ON v.gid = g.gid),
a AS (SELECT gid, update_id, row_no FROM c WHERE accepted UNION ALL SELECT gid, update_id, row_no FROM d WHERE accepted),""" + _SLOTS),
    "segment_depth": with_(_BOOKS + _LEVELS + "," + _claimed(2, "true"), f"""
, w AS (SELECT gid AS lid, 2 * count(*) AS seq, max(update_id) AS update_id, arg_max(row_no, update_id) AS row_no FROM c WHERE accepted GROUP BY gid),
l AS (SELECT CAST(x AS INT) AS lid FROM (SELECT unnest(range(27)) AS x))
SELECT l.lid, coalesce(seq, 0) AS seq, coalesce(w.update_id, 0) AS update_id, coalesce(depth, 0) AS depth, coalesce(scale, 0) AS price_scale, 0 AS qty_scale,
       coalesce(bid_px, '{_ZEROS}') AS bid_px, coalesce(bid_qty, '{_ZEROS}') AS bid_qty, coalesce(ask_px, '{_ZEROS}') AS ask_px, coalesce(ask_qty, '{_ZEROS}') AS ask_qty
FROM l LEFT JOIN w USING (lid) LEFT JOIN m ON m.row_no = w.row_no LEFT JOIN k ON k.row_no = w.row_no"""),
    "segment_trades": with_(_LOG, f"SELECT {_LOG_ROWS}, CAST({frac_length('spx')} AS INT) AS price_scale, 0 AS qty_scale FROM p WHERE slot >= head - 4096"),
    "segment_drain": with_(_LOG, """
SELECT count(*) AS delivered, min(slot) AS first_slot, CAST(sum(CAST(sqty AS BIGINT)) AS BIGINT) AS qty, any_value(greatest(0, head - 10 - 4096)) AS lapped, any_value(head) AS next_slot
FROM p WHERE slot >= greatest(10, head - 4096)"""),
    "paced_trades": with_(_LOG, f"SELECT {_LOG_ROWS} FROM p WHERE slot >= head - 4096"),
    "replay_report": with_(_TRADES + """,
b AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY row_no) + 1 AS bline, CASE WHEN row_no % 59 = 0 THEN 'malformed' WHEN row_no % 71 = 0 THEN 'bad_ts' WHEN row_no % 67 = 0 THEN 'bad_field'
             WHEN gid >= 27 THEN 'unknown_symbol' WHEN row_no % 61 = 0 THEN 'bad_number' WHEN row_no % 57 = 0 THEN 'scale_overflow' END AS bad FROM t WHERE src % 3 = 0)""", f"""
, v AS (SELECT *, max(ts_ns) OVER (PARTITION BY src ORDER BY bline ROWS UNBOUNDED PRECEDING) AS merge_ts FROM b WHERE bad IS NULL),
c AS (SELECT *, update_id > coalesce(max(update_id) OVER (PARTITION BY gid ORDER BY merge_ts, src, bline ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS accepted FROM v WHERE merge_ts <= {END}),
z AS (SELECT src, min(bline) AS second FROM (SELECT src, bline, row_number() OVER (PARTITION BY src ORDER BY bline) AS n FROM v WHERE merge_ts > {END}) WHERE n = 2 GROUP BY src),
q AS (SELECT why AS what FROM f WHERE why IS NOT NULL UNION ALL SELECT bad FROM b LEFT JOIN z USING (src) WHERE bad IS NOT NULL AND (second IS NULL OR bline < second))
SELECT 'quotes' AS what, count(*) AS n FROM c UNION ALL SELECT 'trades', 0 UNION ALL SELECT 'stale', count(*) FROM c WHERE NOT accepted UNION ALL SELECT 'not written', count(*) FROM f WHERE why IS NULL
UNION ALL SELECT 'last', greatest((SELECT max(ts_ns) FROM c), (SELECT max(ts_ns) FROM f WHERE why IS NULL)) UNION ALL SELECT what, count(*) FROM q GROUP BY what"""),
    "summary_lines": with_(_TRADES, f"""
, n AS (SELECT why, count(*) AS n FROM f WHERE why IS NOT NULL GROUP BY why), o(place, why) AS (VALUES {_REASONS})
SELECT 0 AS line, 'rejected rows: ' || CAST(sum(n) AS BIGINT) || ' (' || string_agg(n || ' ' || why, ', ' ORDER BY place) || ')' AS text FROM n JOIN o USING (why)
UNION ALL SELECT 1, 'unknown symbols: ' || string_agg(DISTINCT symbol, ', ' ORDER BY symbol) FROM f WHERE why = 'unknown_symbol' HAVING count(*) > 0"""),
    "found_files": with_(TICKS, """
SELECT 0 AS place, 'A.trade.csv' AS file, 'ok' AS state, 0 AS src, 0 AS rows UNION ALL SELECT 1, 'empty.trade.csv', 'CSV_SCHEMA', NULL, 0 UNION ALL SELECT 2, 'header.trade.csv', 'ok', 1, 0
UNION ALL SELECT 3, 'lacking.trade.csv', 'CSV_SCHEMA', NULL, 0 UNION ALL SELECT 4, 's000.trade.csv', 'ok', 2, count(*) FROM t WHERE src = 0 UNION ALL SELECT 5, 's001.trade.csv', 'ok', 3, count(*) FROM t WHERE src = 1"""),
    "unit_errors": _values("unit, state", [("depths", "BOOK_DEPTH_UNSUPPORTED"), ("none", "FILE_OPEN"), ("neither", "CONFIG_INVALID"), ("both", "CONFIG_INVALID"), ("csv of both", "depth 1")]),
    "unknown_sample_cap": """
SELECT 'P' || l_partkey % 1000 AS symbol, min(l_orderkey * 8 + l_linenumber) AS first_row, count(*) AS rows FROM lineitem GROUP BY 1 ORDER BY 2, 1 LIMIT 64""",
    "parse_datetimes": """
WITH a AS (SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000000000 + o_orderkey % 86400 * 1000000000 AS ns FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 2 THEN ns END AS datetime_ns, CASE WHEN o_orderkey % 7 IN (0, 1, 5) THEN ns END AS value_ns FROM a""",
    "clock_from_init": with_(GOOD.replace("WHERE gid < 27", ""), f"""
, e AS (SELECT * FROM g WHERE merge_ts <= {END} AND ts_ns >= {START})
SELECT row_no, greatest(0, CAST(trunc(CAST(ts_ns - {MID} AS DOUBLE) * 0.25) AS BIGINT)) AS offset_ns,
       CAST(trunc(CAST((SELECT min(merge_ts) FROM e) - {MID} AS DOUBLE) * 0.5 / 1e9) AS BIGINT) AS delay_s FROM e"""),
    "segment_layouts": _values("layout, kind, entry_size, capacity, hash, bytes", [("bbo", 1, 64, 27, "c0820a5fb350b598", 2048), ("depth", 1, 448, 27, "74b01e065bf4c589", 12416), ("trade", 2, 64, 4096, "1ed29fc435a25cc3", 262272)]),
    "config_settings": _values("setting, value", [
        ("realtime", "0.5"), ("init_ts", "1704412800000000000"), ("level", "30"), ("progress", "5"), ("over.realtime", "0.0"), ("over.init_ts", "17"), ("over.level", "10"), ("over.progress", "-1"),
        ("0.format", "csv"), ("0.kind", "book"), ("0.path", "bbo"), ("0.create", "True"), ("0.start", "-9223372036854775808"), ("0.end", "1705708800000000000"),
        ("1.format", "json"), ("1.kind", "trade"), ("1.path", "log"), ("1.create", "False"), ("1.start", "1704412800000000000"), ("1.end", "9223372036854775807"),
    ]),
    "config_errors": _values("job, state", [(x, "ok" if x in ("equal", "auto") else "CONFIG_INVALID") for x in ("fast", "nan", "no path", "no replays", "no input", "kind", "format", "same path", "order", "datetime", "equal", "auto")]),
}
