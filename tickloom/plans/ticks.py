"""Tick streams from the driver's tables, which have no tick files: events become trades or one-level books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import BAD_FIELD, BAD_TS, UNKNOWN_SYMBOL
from ..functions import fixed
from ..functions.symbols import SYMBOLS, gid_of
from ..sources.records import encoded

HOUR = 3600 * 10**9


def spread(df: DataFrame) -> DataFrame:
    """A scan dealt out anew if it has too few partitions to keep the session's cores busy, as a single small file has; any
    larger input is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.queryExecution().toRdd().getNumPartitions() <= cores else df


def ticks(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """(src, unit, row_no, ts_ns, symbol, update_id, px, qty, side): a source for each event type, units of even and odd
    sources, times that go back by up to four hours, ids that aren't monotone, three unknown names and one bad side in three. heavy: much is worked out for each row."""
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    events = stored.select("event_id", "ts", "user_id", "event_type", "value", "props")
    events = spread(events) if heavy else events
    kinds = stored.select("event_type").distinct().withColumn("src", (F.row_number().over(Window.orderBy("event_type")) - 1).cast("int"))
    name = F.get(F.array(*map(F.lit, [*SYMBOLS, "UNK27", "UNK28", "UNK29"])), (F.col("user_id") % 30).cast("int"))
    return events.join(F.broadcast(kinds), "event_type").select(
        "src",
        (F.col("src") % 2).alias("unit"),
        F.col("event_id").alias("row_no"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 - F.col("event_id") % 5 * HOUR).alias("ts_ns"),
        name.alias("symbol"),
        (F.col("event_id") * 7919 % 10007).alias("update_id"),
        F.col("value").cast("string").alias("px"),
        F.get_json_object("props", "$.k").alias("qty"),
        (F.col("event_id") % 3).alias("side"),
    )


def chunk_of_rows() -> Column:
    from ..operators.scans import CHUNK_ROWS

    return F.floor(F.col("row_no") / CHUNK_ROWS)


def chunk_of_time(spark: SparkSession, sf_dir: str) -> Column:
    """Chunks of the merged order with about as many events each: the bounds come from one column of the table."""
    from ..operators.scans import bounds_of, chunk_by

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return chunk_by(bounds_of(events.select((F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("t")), "t"), F.col("merge_ts"))


def books(rows: DataFrame) -> DataFrame:
    """rows as one-level book records: the bid is px, the ask px with a trailing 5. Adds reason, lid and encoded levels."""
    rows = rows.withColumn("lid", gid_of(F.col("symbol")))
    level = lambda group, k: F.get(group["mantissas"], F.lit(k))
    fields = lambda px, qty: {"bid_px": level(px, 0), "ask_px": level(px, 1), "bid_qty": level(qty, 0), "ask_qty": level(qty, 1)}
    return encoded(rows, F.array("px", F.concat("px", F.lit("5"))), F.array("qty", "qty"), [(UNKNOWN_SYMBOL, F.col("lid").isNull())], fields)


def spoiled(rows: DataFrame) -> DataFrame:
    """rows as text with faults in some: times, prices and quantities that aren't numbers or too large."""
    n = F.col("row_no")
    return rows.select(
        "src", "unit", "row_no", "ts_ns", "symbol", F.col("side").cast("string").alias("side"),
        F.when(n % 83 == 0, "12x").otherwise(F.col("ts_ns").cast("string")).alias("ts"),
        F.when(n % 97 == 0, "6x.8").when(n % 89 == 0, "-1").otherwise(F.col("px")).alias("px"),
        F.when(n % 79 == 0, "5000000000").when(n % 73 == 0, "").otherwise(F.col("qty")).alias("qty"),
    )


def trades(rows: DataFrame) -> DataFrame:
    """Text rows as trades: reason of the first failed check, gid, and px and qty each at a scale of its own."""
    rows = rows.withColumns({"gid": gid_of(F.col("symbol")), "_ts": fixed.to_i64(F.col("ts")), "_side": fixed.to_i64(F.col("side"))})
    side = F.col("_side").isNull() | ~F.col("_side").isin(0, 1)
    first = lambda group: F.get(group["mantissas"], F.lit(0))
    checks = [(BAD_TS, F.col("_ts").isNull()), (BAD_FIELD, side), (UNKNOWN_SYMBOL, F.col("gid").isNull())]
    out = encoded(rows, F.array("px"), F.array("qty"), checks, lambda px, qty: {"px_m": first(px), "qty_m": first(qty)})
    return out.withColumnRenamed("price_scale", "px_scale").drop("_ts", "_side")
