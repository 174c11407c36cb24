"""Times in nanoseconds since 1970 (UTC), as whole numbers: Spark's timestamps have microseconds only."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bounds of a window without start or end.
NO_START, NO_END = -(1 << 63), (1 << 63) - 1
_DATETIME = re.compile(r"\s*([+-]?\d+)-\s*([+-]?\d+)-\s*([+-]?\d+)\s*([+-]?\d+):\s*([+-]?\d+):\s*([+-]?\d+)")


def parse_datetime_ns(text: str, empty: int) -> int | None:
    """"2026-6-1 9:05:00" (zeros may be missing, nothing may follow) as nanoseconds; empty for ""; None if no such time."""
    if text == "":
        return empty
    m = _DATETIME.fullmatch(text)
    try:
        seconds = int(datetime(*map(int, m.groups()), tzinfo=timezone.utc).timestamp()) if m else None
    except (ValueError, OverflowError):
        return None
    return None if seconds is None or seconds == -1 else seconds * 10**9


def parse_ts_value(text: str) -> int | None:
    """Whole number: nanoseconds; else a datetime; None if empty or neither."""
    if text == "":
        return None
    if re.fullmatch(r"\s*[+-]?[0-9]+", text):
        return max(NO_START, min(NO_END, int(text)))
    return parse_datetime_ns(text, 0)


def datetime_ns(text: Column) -> Column:
    """parse_datetime_ns for a column: null for "" and for what is no time."""
    part = lambda k: F.regexp_extract(text, r"^\s*(\d{1,4})-\s*(\d{1,2})-\s*(\d{1,2})\s*(\d{1,2}):\s*(\d{1,2}):\s*(\d{1,2})$", k).try_cast("int")
    at = F.try_make_timestamp(part(1), part(2), part(3), part(4), part(5), part(6))
    seconds = F.unix_seconds(at)
    return F.when((part(6) < 60) & (seconds != -1), seconds * 1_000_000_000)


def ts_value_ns(text: Column) -> Column:
    """parse_ts_value for a column: a whole number is nanoseconds, anything else a datetime."""
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+$"), F.trim(text).try_cast("bigint")).otherwise(datetime_ns(text))


def offset_ns(ts: Column, ts0: Column | int | None, realtime: float) -> Column:
    """Wall time from the start of a replay to an event: (ts - ts0) * realtime cut to whole nanoseconds, not below 0; 0 without ts0."""
    if ts0 is None:
        return F.lit(0).cast("bigint")
    ts0 = ts0 if isinstance(ts0, Column) else F.lit(ts0)
    return F.coalesce(F.greatest(F.lit(0).cast("bigint"), ((ts - ts0).cast("double") * F.lit(float(realtime))).cast("bigint")), F.lit(0).cast("bigint"))


def init_delay_s(first_ts: int, init_ts: int, realtime: float) -> float:
    """Seconds until the first event when the clock starts at init_ts; negative if that lies after it."""
    return (first_ts - init_ts) * realtime / 1e9
