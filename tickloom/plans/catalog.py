"""Named queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import depth, fixed, times
from ..functions.symbols import gid_of, symbol_table, to_gid
from ..operators import boards, merge, rejects, ring
from ..operators.scans import bounds_of, chunk_by, position
from ..sources.csv_ticks import tokenize
from ..sources.jsonl_ticks import json_trades
from . import catalog_files
from .sql import END, FRAC, GOOD, MANT, SPOILED, START, TICKS, U32, frac_length, with_
from .ticks import books, chunk_of_rows, chunk_of_time, spoiled, ticks, trades

#: Windows of queries over two units.
WINDOWS = {0: (START, END), 1: (times.NO_START, END)}


def _emitted(spark: SparkSession, sf_dir: str, windows=None) -> DataFrame:
    """Ticks with known symbols in merge order, inside their windows."""
    good = ticks(spark, sf_dir).withColumn("lid", gid_of(F.col("symbol"))).where("lid IS NOT NULL")
    return merge.emitted(good, windows, chunk_of_rows())


def _claimed(spark, sf_dir, windows=None, best=None) -> DataFrame:
    return boards.claim(_emitted(spark, sf_dir, windows), best=best, chunk=chunk_of_time(spark, sf_dir))


def bbo_board(spark, sf_dir):
    """The latest accepted one-level quote of each unit and symbol."""
    good = books(ticks(spark, sf_dir, heavy=True)).where("reason IS NULL")
    claimed = boards.claim(merge.emitted(good, WINDOWS, chunk_of_rows()), chunk=chunk_of_time(spark, sf_dir))
    fields = ["bid_px", "bid_qty", "ask_px", "ask_qty", "price_scale", "qty_scale"]
    return boards.board(claimed, fields)


def board_latest(spark, sf_dir):
    """The same quotes without counters, by one aggregation."""
    good = books(ticks(spark, sf_dir, heavy=True)).where("reason IS NULL")
    return boards.latest(merge.emitted(good, WINDOWS, chunk_of_rows()), ["bid_px", "ask_px", "price_scale"])


def dedup_counts(spark, sf_dir):
    return boards.dedup_counts(_claimed(spark, sf_dir))


def best_update_id(spark, sf_dir):
    return _emitted(spark, sf_dir).groupBy("unit", "lid").agg(F.max("update_id").alias("best_uid"))


def segment_attach(spark, sf_dir):
    """A second run over all rows onto the board that a run over the windows left: its best ids go on counting."""
    best = boards.board(_claimed(spark, sf_dir, WINDOWS), ["px"]).select("unit", "lid", "best_uid")
    return boards.board(_claimed(spark, sf_dir, best=best), ["px"]).select("unit", "lid", "seq", "update_id", "exch_ns", "px")


def depth_board(spark, sf_dir):
    """Books from all line items of an order, line k as level k - 1, where their number is a depth that books have; all levels
    share a scale. One row for each level."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    level = F.struct((F.col("l_linenumber") - 1).alias("level"), F.col("l_extendedprice").cast("string").alias("p"), F.col("l_quantity").cast("string").alias("q"))
    levels = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(level)).alias("levels"))
    of = lambda f: F.transform("levels", lambda x: x[f])
    levels = levels.withColumn("depth", depth.book_depth_column(F.filter(of("level"), lambda k: k > 0))).where((F.col("depth") == F.size("levels")) & (F.get(of("level"), F.lit(0)) == 0))
    rows = levels.withColumns({"px": fixed.encode_group(of("p")), "qty": fixed.encode_group(of("q"))}).where("px.status = 'ok' AND qty.status = 'ok'").select(
        F.lit(0).alias("unit"), F.lit(0).alias("src"), F.col("l_orderkey").alias("row_no"), F.col("l_orderkey").alias("ts_ns"), F.col("l_orderkey").alias("merge_ts"),
        (F.col("l_orderkey") % 27).cast("int").alias("lid"), (F.col("l_orderkey") * 7919 % 100003).alias("update_id"), "depth",
        F.col("px.scale").alias("price_scale"), F.col("qty.scale").alias("qty_scale"), F.col("px.mantissas").alias("bid_px"), F.col("qty.mantissas").alias("bid_qty"),
        F.col("px.mantissas").alias("ask_px"), F.col("qty.mantissas").alias("ask_qty"),
    )
    orders = bounds_of(items.where("l_linenumber = 1").select("l_orderkey"), "l_orderkey")
    claimed = boards.claim(boards.padded_levels(rows), chunk=chunk_by(orders, F.col("merge_ts")))
    won = boards.board(claimed, ["depth", "price_scale", "qty_scale", "bid_px", "bid_qty"])
    out = won.select("lid", "seq", "update_id", "depth", "price_scale", "qty_scale", F.posexplode(F.arrays_zip("bid_px", "bid_qty")).alias("level", "x"))
    return out.select("lid", "seq", "update_id", "depth", "price_scale", "qty_scale", "level", F.col("x.bid_px").alias("bid_px"), F.col("x.bid_qty").alias("bid_qty"))


def merge_order(spark, sf_dir):
    """The place of every emitted row in the global order."""
    return position(_emitted(spark, sf_dir), [], merge.ORDER, "place", chunk_of_time(spark, sf_dir)).select("row_no", "src", "merge_ts", "place")


def unit_window(spark, sf_dir):
    return _emitted(spark, sf_dir, WINDOWS).select("unit", "src", "row_no", "ts_ns", "merge_ts")


def unit_routing(spark, sf_dir):
    """Rows, first and last time and largest id of what is routed to each unit's output."""
    return _emitted(spark, sf_dir, WINDOWS).groupBy("unit").agg(F.count(F.lit(1)).alias("rows"), F.min("merge_ts").alias("first_ns"), F.max("merge_ts").alias("last_ns"), F.sum("update_id").alias("uid_sum"))


def _long_price():
    """Prices with up to seven decimals, some of which have to lose a few to fit 32 bits."""
    return F.concat("px", F.lpad((F.col("row_no") % 100_000).cast("string"), 5, "0"))


def encode_price(spark, sf_dir):
    rows = ticks(spark, sf_dir).withColumn("e", fixed.encode_group(F.array(_long_price())))
    return rows.select("row_no", F.col("e.scale").alias("scale"), F.get(F.col("e.mantissas"), F.lit(0)).alias("mantissa"))


def encode_group(spark, sf_dir):
    rows = ticks(spark, sf_dir).withColumn("e", fixed.encode_group(F.array(_long_price(), "px", "qty")))
    return rows.select("row_no", F.col("e.status").alias("status"), F.col("e.scale").alias("scale"), *[F.get(F.col("e.mantissas"), F.lit(i)).alias(f"m{i}") for i in range(3)])


def decode_decimal(spark, sf_dir):
    scale = (F.col("row_no") % 6).cast("int")
    return ticks(spark, sf_dir).select("row_no", fixed.to_decimal(F.col("update_id"), scale).alias("text"))


def symbol_lookup(spark, sf_dir):
    rows = ticks(spark, sf_dir).join(F.broadcast(symbol_table(spark)), "symbol", "left")
    return rows.groupBy("symbol", "gid").agg(F.count(F.lit(1)).alias("rows"), F.max(to_gid(F.coalesce("gid", F.lit(99)))).alias("global_id"))


def unknown_symbols(spark, sf_dir):
    return rejects.unknown_symbols(books(ticks(spark, sf_dir, heavy=True)))


def _trades(spark, sf_dir):
    return trades(spoiled(ticks(spark, sf_dir, heavy=True)))


def skip_counts(spark, sf_dir):
    return rejects.skip_counts(_trades(spark, sf_dir))


def skip_counts_windowed(spark, sf_dir):
    """Rejects that a replay up to END comes across."""
    rows = _trades(spark, sf_dir)
    merged = merge.with_merge_ts(rows.where("reason IS NULL"), chunk_of_rows())
    windows = {0: (START, END), 1: (START, END)}
    return rejects.skip_counts(rejects.counted(rows, merged, windows))


def trade_encoding(spark, sf_dir):
    return _trades(spark, sf_dir).where("reason IS NULL").select("row_no", "gid", "px_m", "px_scale", "qty_m", "qty_scale")


def trade_ring_tail(spark, sf_dir):
    out = ring.tail(_emitted(spark, sf_dir), [0, 1])
    return out.select("unit", "slot", "ring_idx", "seq", F.col("ts_ns").alias("exch_ns"), F.col("lid").alias("gid"), "px")


def ring_drain(spark, sf_dir):
    """What a reader at slot 100 of unit 0 gets after all trades are out."""
    log = _emitted(spark, sf_dir).where("unit = 0")
    head = log.count()
    got, lapped, after = ring.drain(ring.tail(log, [0]), 100, head)
    return got.agg(F.count(F.lit(1)).alias("delivered"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.sum("update_id").alias("uid_sum")).withColumns({"lapped": F.lit(lapped).cast("long"), "next_slot": F.lit(after).cast("long")})


def ring_wraps(spark, sf_dir):
    return ring.wraps(_emitted(spark, sf_dir), capacity=512)


def pace_offsets(spark, sf_dir):
    """When each emitted row is due at double speed, from the first emitted row on."""
    rows = _emitted(spark, sf_dir, {0: (START, END), 1: (START, END)})
    first = rows.agg(F.min("merge_ts").alias("ts0"))
    return rows.join(F.broadcast(first)).select("row_no", times.offset_ns(F.col("ts_ns"), F.col("ts0"), 0.5).alias("offset_ns"))


def replay_summary(spark, sf_dir):
    """Emitted, accepted and deduplicated rows, symbols and last time of each unit."""
    claimed = _claimed(spark, sf_dir, WINDOWS)
    return claimed.groupBy("unit").agg(F.count(F.lit(1)).alias("emitted"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("deduped"), F.countDistinct("lid").alias("symbols"), F.max("merge_ts").alias("last_ns"))


def _csv_line():
    """A CSV line per event, whose second field is plain, quoted, quoted with quotes and junk after, or left open."""
    n, t = F.col("event_id"), F.col("event_type")
    second = F.when(n % 4 == 0, t).when(n % 4 == 1, F.concat(F.lit('"'), t, F.lit(',"'))).when(n % 4 == 2, F.concat(F.lit('"a""'), t, F.lit('"junk'))).otherwise(F.concat(F.lit('"'), t))
    return F.concat_ws(",", n.cast("string"), second, F.col("user_id").cast("string"), F.lit(""))


def csv_tokenize(spark, sf_dir):
    fields = tokenize(_csv_line())
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.size(fields).alias("fields"), F.get(fields, F.lit(1)).alias("second"), F.get(fields, F.size(fields) - 1).alias("last"))


def jsonl_extract(spark, sf_dir):
    """Trades from JSON lines built of events: some lack a key, have a number where text is due, or aren't objects."""
    n = F.col("event_id")
    obj = lambda px, side: F.concat(F.lit('{"ts": '), n.cast("string"), F.lit(', "symbol": "SOLUSDT", "px": '), px, F.lit(', "qty": "'), F.get_json_object("props", "$.k"), F.lit('"'), side, F.lit("}"))
    text = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    side = F.concat(F.lit(', "side": '), (n % 2).cast("string"))
    line = F.when(n % 11 == 0, F.lit("[1, 2]")).when(n % 13 == 0, obj(F.col("value").cast("string"), side)).when(n % 17 == 0, obj(text, F.lit(""))).when(n % 19 == 0, F.lit('{"ts": 1')).otherwise(obj(text, side))
    out = json_trades(spark, spark.read.parquet(f"{sf_dir}/events.parquet").select(n.alias("row_no"), line.alias("value")))
    return out.select("row_no", "reason", "ts_ns", "side", "px", "qty", "price_scale")


def depth_detect(spark, sf_dir):
    """Depth of books whose extra levels are an order's line numbers."""
    levels = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("levels"))
    return levels.select("l_orderkey", depth.book_depth_column(F.col("levels")).alias("depth"), depth.highest_level_column(F.col("levels")).cast("int").alias("highest"))


def depth_agreement(spark, sf_dir):
    """The depth of each source's first record (1 or 5, by its first symbol), and whether all sources agree."""
    first = _emitted(spark, sf_dir).groupBy("src").agg(F.min_by("lid", "row_no").alias("lid"))
    first = first.select("src", F.when(F.col("lid") % 2 == 0, 1).otherwise(5).alias("depth"))
    return first.agg(F.count(F.lit(1)).alias("sources"), F.min("depth").alias("least"), F.max("depth").alias("most"), (F.min("depth") == F.max("depth")).alias("agree"))


def strict_int(spark, sf_dir):
    """Whole-text integers: blanks, signs and excess digits make some null."""
    n = F.col("row_no")
    text = F.when(n % 7 == 0, F.concat(F.lit(" "), "qty")).when(n % 7 == 1, F.concat(F.lit("+"), "qty")).when(n % 7 == 2, F.concat(F.lit("-"), "qty")).when(n % 7 == 3, F.concat("qty", F.lit("99999999999999999999"))).when(n % 7 == 4, F.concat("qty", F.lit("x"))).otherwise(F.concat(F.lit("000"), "qty"))
    return ticks(spark, sf_dir).select("row_no", fixed.to_i64(text).alias("i64"), fixed.to_u64(text).cast("string").alias("u64"))


QUERIES = {
    f.__name__: f
    for f in (
        bbo_board, board_latest, dedup_counts, best_update_id, segment_attach, depth_board, merge_order, unit_window, unit_routing, encode_price, encode_group, decode_decimal, symbol_lookup,
        unknown_symbols, skip_counts, skip_counts_windowed, trade_encoding, trade_ring_tail, ring_drain, ring_wraps, pace_offsets, replay_summary, csv_tokenize, jsonl_extract, depth_detect,
        depth_agreement, strict_int,
    )
}

_ALL = GOOD + ", e AS (SELECT * FROM g)"
_WIN = GOOD + f", e AS (SELECT * FROM g WHERE merge_ts <= {END} AND (unit = 1 OR ts_ns >= {START}))"
_CLAIM = """,
c AS (SELECT *, update_id > coalesce(max(update_id) OVER (PARTITION BY unit, lid ORDER BY merge_ts, src, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS accepted FROM e)"""


_LONG = TICKS + ", p AS (SELECT *, px || lpad(CAST(row_no % 100000 AS VARCHAR), 5, '0') AS lp FROM t)"
SQL = {
    "bbo_board": with_(_WIN + _CLAIM, """
, b AS (SELECT unit, lid, 2 * count(*) AS seq, arg_max(ts_ns, update_id) AS exch_ns, max(update_id) AS update_id, arg_max(px, update_id) AS px, arg_max(qty, update_id) AS qty
        FROM c WHERE accepted GROUP BY unit, lid),
d AS (SELECT *, split_part(px, '.', 2) AS f FROM b)
SELECT unit, lid, seq, exch_ns, update_id, CAST(split_part(px, '.', 1) || rpad(f, CAST(length(f) + 1 AS INT), '0') AS BIGINT) AS bid_px, CAST(qty AS BIGINT) AS bid_qty,
       CAST(split_part(px, '.', 1) || f || '5' AS BIGINT) AS ask_px, CAST(qty AS BIGINT) AS ask_qty, CAST(length(f) + 1 AS INT) AS price_scale, 0 AS qty_scale, update_id AS best_uid FROM d"""),
    "board_latest": with_(_WIN, """
, b AS (SELECT unit, lid, arg_max(ts_ns, update_id) AS exch_ns, max(update_id) AS update_id, arg_max(px, update_id) AS px FROM e WHERE update_id > 0 GROUP BY unit, lid),
d AS (SELECT *, split_part(px, '.', 2) AS f FROM b)
SELECT unit, lid, exch_ns, update_id, CAST(split_part(px, '.', 1) || rpad(f, CAST(length(f) + 1 AS INT), '0') AS BIGINT) AS bid_px, CAST(split_part(px, '.', 1) || f || '5' AS BIGINT) AS ask_px,
       CAST(length(f) + 1 AS INT) AS price_scale, update_id AS best_uid FROM d"""),
    "dedup_counts": with_(_ALL + _CLAIM, "SELECT unit, count(*) AS emitted, count(*) FILTER (WHERE accepted) AS accepted, count(*) FILTER (WHERE NOT accepted) AS deduped FROM c GROUP BY unit"),
    "best_update_id": with_(_ALL, "SELECT unit, lid, max(update_id) AS best_uid FROM e GROUP BY unit, lid"),
    "segment_attach": with_(_WIN, """
, f AS (SELECT unit, lid, max(update_id) AS floor FROM e GROUP BY unit, lid),
c AS (SELECT g.*, update_id > greatest(coalesce(max(update_id) OVER (PARTITION BY unit, lid ORDER BY merge_ts, src, row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), coalesce(floor, 0)) AS accepted
      FROM g LEFT JOIN f USING (unit, lid))
SELECT unit, lid, 2 * count(*) AS seq, max(update_id) AS update_id, arg_max(ts_ns, update_id) AS exch_ns, arg_max(px, update_id) AS px FROM c WHERE accepted GROUP BY unit, lid"""),
    "depth_board": f"""
WITH i AS (SELECT l_orderkey AS k, l_linenumber - 1 AS n, CAST(l_extendedprice AS VARCHAR) AS p, CAST(l_quantity AS VARCHAR) AS q FROM lineitem),
o AS (SELECT k, CAST(k % 27 AS INT) AS lid, k * 7919 % 100003 AS update_id, CAST(count(*) AS INT) AS depth, max({frac_length('p')}) AS ps, max({frac_length('q')}) AS qs FROM i GROUP BY k
      HAVING count(*) IN (1, 5, 10, 15, 20, 25) AND count(DISTINCT n) = count(*) AND min(n) = 0 AND max(n) = count(*) - 1),
c AS (SELECT *, update_id > coalesce(max(update_id) OVER (PARTITION BY lid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS accepted FROM o),
w AS (SELECT lid, 2 * count(*) AS seq, max(update_id) AS update_id, arg_max(k, update_id) AS k, arg_max(depth, update_id) AS depth, arg_max(ps, update_id) AS ps, arg_max(qs, update_id) AS qs FROM c WHERE accepted GROUP BY lid),
l AS (SELECT w.*, unnest(range(25)) AS level FROM w)
SELECT lid, seq, update_id, depth, CAST(ps AS INT) AS price_scale, CAST(qs AS INT) AS qty_scale, CAST(level AS INT) AS level,
       coalesce(CAST({MANT.format(v='p', s='ps')} AS BIGINT), 0) AS bid_px,
       coalesce(CAST({MANT.format(v='q', s='qs')} AS BIGINT), 0) AS bid_qty FROM l LEFT JOIN i ON i.k = l.k AND i.n = l.level""",
    "merge_order": with_(_ALL, "SELECT row_no, src, merge_ts, row_number() OVER (ORDER BY merge_ts, src, row_no) - 1 AS place FROM e"),
    "unit_window": with_(_WIN, "SELECT unit, src, row_no, ts_ns, merge_ts FROM e"),
    "unit_routing": with_(_WIN, "SELECT unit, count(*) AS rows, min(merge_ts) AS first_ns, max(merge_ts) AS last_ns, CAST(sum(update_id) AS BIGINT) AS uid_sum FROM e GROUP BY unit"),
    "encode_price": with_(_LONG, f"""
, k AS (SELECT row_no, lp, unnest(range({frac_length('lp')} + 1)) AS s FROM p), m AS (SELECT row_no, s, {MANT.format(v='lp', s='s')} AS m FROM k)
SELECT row_no, CAST(max(s) AS INT) AS scale, CAST(arg_max(m, s) AS BIGINT) AS mantissa FROM m WHERE m <= {U32} GROUP BY row_no"""),
    "encode_group": with_(_LONG, f"""
, k AS (SELECT row_no, lp, px, qty, unnest(range(greatest({frac_length('lp')}, {frac_length('px')}, {frac_length('qty')}) + 1)) AS s FROM p),
m AS (SELECT row_no, s, {MANT.format(v='lp', s='s')} AS m0, {MANT.format(v='px', s='s')} AS m1, {MANT.format(v='qty', s='s')} AS m2 FROM k)
SELECT row_no, 'ok' AS status, CAST(max(s) AS INT) AS scale, CAST(arg_max(m0, s) AS BIGINT) AS m0, CAST(arg_max(m1, s) AS BIGINT) AS m1, CAST(arg_max(m2, s) AS BIGINT) AS m2
FROM m WHERE greatest(m0, m1, m2) <= {U32} GROUP BY row_no"""),
    "decode_decimal": with_(TICKS, """
, d AS (SELECT row_no, CAST(row_no % 6 AS INT) AS s, lpad(CAST(update_id AS VARCHAR), CAST(greatest(length(CAST(update_id AS VARCHAR)), row_no % 6 + 1) AS INT), '0') AS x FROM t)
SELECT row_no, CASE WHEN s = 0 THEN x ELSE left(x, length(x) - s) || '.' || right(x, s) END AS text FROM d"""),
    "symbol_lookup": with_(TICKS, "SELECT symbol, CASE WHEN gid < 27 THEN gid END AS gid, count(*) AS rows, CASE WHEN gid < 27 THEN gid ELSE -1 END AS global_id FROM t GROUP BY symbol, gid"),
    "unknown_symbols": with_(TICKS, "SELECT symbol, min(row_no) AS first_row, count(*) AS rows FROM t WHERE gid >= 27 GROUP BY symbol"),
    "skip_counts": with_(SPOILED, "SELECT reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY reason"),
    "skip_counts_windowed": with_(SPOILED, f"""
, m AS (SELECT src, row_no, max(ts_ns) OVER (PARTITION BY src ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS merge_ts FROM r WHERE reason IS NULL),
q AS (SELECT src, row_no, row_number() OVER (PARTITION BY src ORDER BY row_no) AS n FROM m WHERE merge_ts > {END}),
z AS (SELECT src, row_no AS second FROM q WHERE n = 2)
SELECT reason, count(*) AS rows FROM r LEFT JOIN z USING (src) WHERE reason IS NOT NULL AND (second IS NULL OR row_no < second) GROUP BY reason"""),
    "trade_encoding": with_(SPOILED, f"""
SELECT row_no, gid, CAST(split_part(spx, '.', 1) || {FRAC.format(v='spx')} AS BIGINT) AS px_m, CAST({frac_length('spx')} AS INT) AS px_scale, CAST(sqty AS BIGINT) AS qty_m, 0 AS qty_scale FROM r WHERE reason IS NULL"""),
    "trade_ring_tail": with_(_ALL, """
, n AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY merge_ts, src, row_no) - 1 AS slot, count(*) OVER (PARTITION BY unit) AS head FROM e)
SELECT unit, slot, CAST(slot % 4096 AS INT) AS ring_idx, 2 * slot AS seq, ts_ns AS exch_ns, lid AS gid, px FROM n WHERE slot >= head - 4096"""),
    "ring_drain": with_(_ALL, """
, n AS (SELECT *, row_number() OVER (ORDER BY merge_ts, src, row_no) - 1 AS slot, count(*) OVER () AS head FROM e WHERE unit = 0)
SELECT count(*) AS delivered, min(slot) AS first_slot, max(slot) AS last_slot, CAST(sum(update_id) AS BIGINT) AS uid_sum, any_value(greatest(0, head - 100 - 4096)) AS lapped, any_value(head) AS next_slot
FROM n WHERE slot >= greatest(100, head - 4096)"""),
    "ring_wraps": with_(_ALL, "SELECT unit, count(*) AS published, CASE WHEN count(*) > 512 THEN count(*) // 512 ELSE 0 END AS wraps FROM e GROUP BY unit"),
    "pace_offsets": with_(GOOD, f"""
, e AS (SELECT * FROM g WHERE merge_ts <= {END} AND ts_ns >= {START}), z AS (SELECT min(merge_ts) AS ts0 FROM e)
SELECT row_no, greatest(0, CAST(trunc(CAST(ts_ns - ts0 AS DOUBLE) * 0.5) AS BIGINT)) AS offset_ns FROM e, z"""),
    "replay_summary": with_(_WIN + _CLAIM, """
SELECT unit, count(*) AS emitted, count(*) FILTER (WHERE accepted) AS accepted, count(*) FILTER (WHERE NOT accepted) AS deduped, count(DISTINCT lid) AS symbols, max(merge_ts) AS last_ns FROM c GROUP BY unit"""),
    "csv_tokenize": """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 2 ELSE 4 END AS fields,
       CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type || ',' WHEN 2 THEN 'a"' || event_type ELSE event_type || ',' || user_id || ',' END AS second,
       CASE WHEN event_id % 4 = 3 THEN event_type || ',' || user_id || ',' ELSE '' END AS last FROM events""",
    "jsonl_extract": """
WITH k AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN 'malformed' WHEN event_id % 13 = 0 THEN 'bad_field' WHEN event_id % 17 = 0 THEN 'bad_field' WHEN event_id % 19 = 0 THEN 'malformed' END AS reason FROM events)
SELECT event_id AS row_no, reason, CASE WHEN reason IS NULL THEN event_id END AS ts_ns, CASE WHEN reason IS NULL THEN event_id % 2 END AS side,
       CASE WHEN reason IS NULL THEN CAST(split_part(CAST(value AS VARCHAR), '.', 1) || {f} AS BIGINT) END AS px, CASE WHEN reason IS NULL THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS qty,
       CASE WHEN reason IS NULL THEN CAST(length({f}) AS INT) END AS price_scale FROM k""".replace("{f}", FRAC.format(v="CAST(value AS VARCHAR)")),
    "depth_detect": """
WITH k AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN n = m AND n + 1 IN (1, 5, 10, 15, 20, 25) THEN CAST(n + 1 AS INT) END AS depth, CAST(m AS INT) AS highest FROM k""",
    "depth_agreement": with_(_ALL, """
, f AS (SELECT src, CASE WHEN arg_min(lid, row_no) % 2 = 0 THEN 1 ELSE 5 END AS depth FROM e GROUP BY src)
SELECT count(*) AS sources, min(depth) AS least, max(depth) AS most, min(depth) = max(depth) AS agree FROM f"""),
    "strict_int": with_(TICKS, """
SELECT row_no, CASE WHEN row_no % 7 = 2 THEN -CAST(qty AS BIGINT) WHEN row_no % 7 > 4 THEN CAST(qty AS BIGINT) END AS i64,
       CASE WHEN row_no % 7 > 4 THEN CAST(CAST(qty AS BIGINT) AS VARCHAR) END AS u64 FROM t"""),
}
QUERIES |= catalog_files.QUERIES
SQL |= catalog_files.SQL
