"""The bounded log of trades: an append-only table, of which a reader sees the last `capacity` of each unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema_hash import RING_CAPACITY
from .merge import ORDER
from .scans import position


def published(trades: DataFrame, start: int = 0, chunk: Column | None = None) -> DataFrame:
    """trades with slot: the place in the unit's log, from start (an existing log's head) on."""
    return position(trades, ["unit"], ORDER, "slot", chunk).withColumn("slot", F.col("slot") + start)


def tail(trades: DataFrame, units: Sequence[int], capacity: int = RING_CAPACITY) -> DataFrame:
    """The last `capacity` trades of each unit with slot, ring_idx and seq (2 * slot; 0 also marks a slot never written).

    A top-k for each unit (as many as a configuration lists), so each task keeps `capacity` rows and no log is ever sorted or
    numbered as a whole. Heads are one small aggregation, joined by unit; nothing runs before the result is asked for.
    """
    parts = [trades.where(F.col("unit") == unit).orderBy(*[F.desc(c) for c in ORDER]).limit(capacity) for unit in units]
    last = parts[0]
    for part in parts[1:]:
        last = last.unionByName(part)
    heads = trades.where(F.col("unit").isin(list(units))).groupBy("unit").agg(F.greatest(F.lit(0), F.count(F.lit(1)) - capacity).alias("_first"))
    out = position(last, ["unit"], ORDER, "slot").join(F.broadcast(heads), "unit")
    out = out.withColumn("slot", F.col("slot") + F.col("_first")).drop("_first").select(*trades.columns, "slot")
    return out.withColumns({"ring_idx": (F.col("slot") % capacity).cast("int"), "seq": 2 * F.col("slot")})


def drain(log: DataFrame, after: int, head: int, capacity: int = RING_CAPACITY) -> tuple[DataFrame, int, int]:
    """What a reader gets who has read up to slot `after` of a log with `head` slots: rows, how many were overwritten unread,
    and where it reads on."""
    lapped = max(0, head - after - capacity)
    first = after + lapped
    return log.where((F.col("slot") >= first) & (F.col("slot") < head)), lapped, head


def wraps(trades: DataFrame, capacity: int = RING_CAPACITY) -> DataFrame:
    """Per unit: trades published, and how often the ring came round (0 unless there were more than it holds)."""
    n = F.count(F.lit(1))
    return trades.groupBy("unit").agg(n.alias("published"), F.when(n > capacity, F.floor(n / capacity)).otherwise(0).cast("bigint").alias("wraps"))
