"""Rejected rows: why, how many, and which unknown symbols."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import REASONS, UNKNOWN_SYMBOL
from .merge import bounds

#: Distinct unknown symbols that a summary names (fixed value).
SAMPLE = 64


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """The reason of the first check that holds, null if none: the order of checks decides."""
    out = None
    for reason, failed in checks:
        out = F.when(failed, reason) if out is None else out.when(failed, reason)
    return out


def skip_counts(rows: DataFrame) -> DataFrame:
    """(reason, rows) of rows with a reason."""
    return rows.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def counted(rows: DataFrame, merged: DataFrame, windows: Mapping[int, tuple[int, int]]) -> DataFrame:
    """Rejected rows that a replay with windows comes across: a source is read on only to the row after the first valid one
    past its unit's end, so rejects behind the second valid row past the end are never seen.

    merged: the valid rows with merge_ts. As that never decreases, rows past the end are a source's last, and the second of
    them is found by two aggregations instead of a window.
    """
    past = merged.where(F.col("merge_ts") > bounds(windows, F.col("unit"))[1])
    first = past.groupBy("src").agg(F.min("row_no").alias("_first"))
    second = past.join(first, "src").where(F.col("row_no") > F.col("_first")).groupBy("src").agg(F.min("row_no").alias("_second"))
    seen = rows.where("reason IS NOT NULL").join(second, "src", "left")
    return seen.where(F.col("_second").isNull() | (F.col("row_no") < F.col("_second"))).drop("_second")


def unknown_symbols(rows: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The first `limit` distinct unknown symbols in reading order (row by row over the sources), with their first row and
    their number of rows."""
    names = rows.where(F.col("reason") == UNKNOWN_SYMBOL).groupBy("symbol").agg(F.min(F.struct("row_no", "src")).alias("_first"), F.count(F.lit(1)).alias("rows"))
    return names.orderBy("_first", "symbol").limit(limit).select("symbol", F.col("_first.row_no").alias("first_row"), "rows")


def summary(counts: Mapping[str, int], unknown: list[str], limit: int = SAMPLE) -> list[str]:
    """Log lines about skipped rows; none if there are none."""
    total = sum(counts.values())
    if not total:
        return []
    lines = [f"rejected rows: {total} ({', '.join(f'{counts[r]} {r}' for r in REASONS if counts.get(r))})"]
    if counts.get(UNKNOWN_SYMBOL):
        more = " and maybe more" if len(unknown) >= limit else ""
        lines.append(f"unknown symbols{more}: {', '.join(sorted(unknown))}")
    return lines
