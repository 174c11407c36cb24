"""The ordered union of sources under one clock, and each unit's time window.

A merge that always takes the source whose next record is earliest (ties: the first source) emits records in the order of
(merge_ts, src, row_no), where merge_ts is the running maximum of ts within the source: a late record follows the one that
overtook it. A source is done once merge_ts passes the unit's end, so later rows are dropped even if their ts is back in
range. Rejected rows must be gone before, as they never reach the merge.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import NO_END, NO_START
from .scans import running_max

ORDER = ["merge_ts", "src", "row_no"]


def with_merge_ts(good: DataFrame, chunk: Column | None = None, sorted_sources: bool = False) -> DataFrame:
    """good (src, row_no, ts_ns) with merge_ts. sorted_sources: ts is known not to decrease in any source, so nothing is scanned."""
    if sorted_sources:
        return good.withColumn("merge_ts", F.col("ts_ns"))
    return running_max(good, ["src"], ["row_no"], F.col("ts_ns"), "merge_ts", chunk)


def is_sorted(good: DataFrame, chunk: Column | None = None) -> bool:
    """Whether ts never decreases within a source: one pass, after which with_merge_ts needs none."""
    seen = running_max(good, ["src"], ["row_no"], F.col("ts_ns"), "_before", chunk, inclusive=False)
    return seen.where(F.col("ts_ns") < F.col("_before")).isEmpty()


def bounds(windows: Mapping[int, tuple[int, int]], unit: Column) -> tuple[Column, Column]:
    """Start and end of each row's unit, as literals: units are as many as a job's configuration lists."""
    start, end = F.lit(NO_START), F.lit(NO_END)
    for number, (first, last) in windows.items():
        start, end = F.when(unit == number, F.lit(first)).otherwise(start), F.when(unit == number, F.lit(last)).otherwise(end)
    return start, end


def windowed(merged: DataFrame, windows: Mapping[int, tuple[int, int]]) -> DataFrame:
    """Rows that the merge emits: ts from the start on, merge_ts up to the end (both inclusive)."""
    start, end = bounds(windows, F.col("unit"))
    return merged.where((F.col("ts_ns") >= start) & (F.col("merge_ts") <= end))


def emitted(good: DataFrame, windows: Mapping[int, tuple[int, int]] | None = None, chunk: Column | None = None, sorted_sources: bool = False) -> DataFrame:
    return windowed(with_merge_ts(good, chunk, sorted_sources), windows or {})


def in_order(rows: DataFrame) -> DataFrame:
    """The global order, for consumers that need it; tables of latest values don't."""
    return rows.orderBy(*ORDER)
