"""Tables of latest values: a book record is accepted if its update id is above all earlier ones of its symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import ORDER
from .scans import running_max

LEVELS = ["bid_px", "bid_qty", "ask_px", "ask_qty"]


def claim(rows: DataFrame, keys: Sequence[str] = ("unit", "lid"), best: DataFrame | None = None, chunk: Column | None = None) -> DataFrame:
    """rows with accepted: update_id above every earlier one of its key in merge order, above best_uid of `best` (keys,
    best_uid: an existing table's) and above 0. Staleness is a matter of ids, not of time."""
    rows = running_max(rows, keys, ORDER, F.col("update_id"), "_best", chunk, inclusive=False)
    floor = F.lit(0)
    if best is not None:
        rows = rows.join(best.select(*keys, F.col("best_uid").alias("_floor")), list(keys), "left")
        floor = F.coalesce("_floor", F.lit(0))
    return rows.withColumn("accepted", F.col("update_id") > F.greatest(F.coalesce("_best", F.lit(0)), floor)).drop("_best", "_floor")


def board(claimed: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("unit", "lid")) -> DataFrame:
    """One row per key with accepted records: the fields of the latest, seq (two steps a write) and best_uid."""
    won = claimed.where("accepted").groupBy(*keys).agg(
        (2 * F.count(F.lit(1))).alias("seq"),
        F.max_by(F.struct("ts_ns", "update_id", *fields), F.col("update_id")).alias("_last"),
        F.max("update_id").alias("best_uid"),
    )
    return won.select(*keys, "seq", F.col("_last.ts_ns").alias("exch_ns"), *[F.col(f"_last.{f}").alias(f) for f in ("update_id", *fields)], "best_uid")


def latest(rows: DataFrame, fields: Sequence[str], keys: Sequence[str] = ("unit", "lid")) -> DataFrame:
    """board() without seq, and without a window: the largest update id above 0, the earliest of equal ones. Partial
    aggregation makes one row per key and task, however hot a symbol is."""
    first = F.struct(F.col("update_id"), -F.col("merge_ts"), -F.col("src"), -F.col("row_no"))
    won = rows.where("update_id > 0").groupBy(*keys).agg(F.max_by(F.struct("ts_ns", "update_id", *fields), first).alias("_last"))
    return won.select(*keys, F.col("_last.ts_ns").alias("exch_ns"), *[F.col(f"_last.{f}").alias(f) for f in ("update_id", *fields)], F.col("_last.update_id").alias("best_uid"))


def top_of_book(rows: DataFrame) -> DataFrame:
    """Level 0 only: what a one-level table stores of a record of any depth."""
    return rows.withColumns({c: F.get(c, F.lit(0)) for c in LEVELS})


def padded_levels(rows: DataFrame, depth: int = 25) -> DataFrame:
    """All levels up to depth, zeros after a record's own."""
    pad = lambda c: F.concat(F.slice(c, 1, depth), F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(0), depth - F.size(c))))
    return rows.withColumns({c: pad(F.col(c)) for c in LEVELS})


def dedup_counts(claimed: DataFrame, keys: Sequence[str] = ("unit",)) -> DataFrame:
    return claimed.groupBy(*keys).agg(F.count(F.lit(1)).alias("emitted"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("deduped"))
