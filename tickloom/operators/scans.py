"""Ordered prefix computations in two levels.

A window over a whole source, symbol or the global order would put a third of all rows into one task as soon as one key is
hot. Here rows are cut into chunks along the order (row blocks, time buckets); windows run inside chunks, a small table with
one row a chunk is scanned over the chunks, and each chunk gets what the earlier ones carry into it. With chunk=None, one
plain window does the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a chunk, about, and chunks at most (a square, as bounds are looked up in two steps).
CHUNK_ROWS, CHUNKS = 1 << 20, 4096


def bounds_of(df: DataFrame, column: str, rows: int = CHUNK_ROWS, least: int | None = None) -> list[int]:
    """Values of a whole-number column that cut its rows into about equal chunks of `rows`, but `least` chunks at least (twice
    the session's cores unless given): approximate quantiles, one partial aggregation. Any bounds give right results; these
    make chunks even, whether the data spans years or a minute."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism if least is None else least
    count = df.count()
    n = max(1, min(CHUNKS, max(-(-count // rows), min(least, count))))
    if n == 1:
        return []
    cuts = df.agg(F.percentile_approx(column, [k / n for k in range(1, n)], 10 * n)).first()[0]
    return sorted(set(cuts or []))


def chunk_by(bounds: Sequence[int], value: Column) -> Column:
    """The chunk of a value: how many bounds are at most it, found among every w-th bound and then among the w behind that."""
    if not bounds:
        return F.lit(0)
    w = max(1, int(len(bounds) ** 0.5))
    every, tops = F.array(*[F.lit(b) for b in bounds]), F.array(*[F.lit(b) for b in bounds[::w]])
    count = lambda xs: F.size(F.filter(xs, lambda b: b <= value))
    block = count(tops)
    return F.when(block == 0, 0).otherwise((block - 1) * w + count(F.slice(every, (block - 1) * w + 1, F.lit(w))))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, chunk: Column | None = None, inclusive: bool = True) -> DataFrame:
    """df with out: the largest value so far in the order within keys; without the current row unless inclusive (null at first)."""
    last = 0 if inclusive else -1
    if chunk is None:
        return df.withColumn(out, F.max(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)))
    on = [*keys, "_chunk"]
    df = df.withColumn("_chunk", chunk)
    inside = F.max(value).over(Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, last))
    tops = df.groupBy(*on).agg(F.max(value).alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*on, F.max("_top").over(before).alias("_carry"))
    return df.withColumn(out, inside).join(carried, on, "left").withColumn(out, F.greatest(out, "_carry")).drop("_chunk", "_carry")


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, chunk: Column | None = None) -> DataFrame:
    """df with out: the 0-based place of each row in the order within keys (none: in all)."""
    if chunk is None:
        return df.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))
    on = [*keys, "_chunk"]
    df = df.withColumn("_chunk", chunk)
    sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select(*on, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_carry"))
    inside = F.row_number().over(Window.partitionBy(*on).orderBy(*order)) - 1
    return df.withColumn(out, inside).join(carried, on).withColumn(out, (F.col(out) + F.col("_carry")).cast("bigint")).drop("_chunk", "_carry")
