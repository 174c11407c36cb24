"""SQL that the catalogs share: ticks made of events, as tables of a WITH clause, and times that queries use."""

from __future__ import annotations

from ..functions import fixed
from ..functions.symbols import SYMBOLS

#: 2024-01-05, 2024-01-12 and 2024-01-20 (UTC).
START, MID, END = 1_704_412_800 * 10**9, 1_705_017_600 * 10**9, 1_705_708_800 * 10**9
_NAMES = ", ".join(f"'{s}'" for s in [*SYMBOLS, "UNK27", "UNK28", "UNK29"])
U32 = fixed.U32_MAX
TICKS = f"""
t AS (
  SELECT CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS src, CAST((dense_rank() OVER (ORDER BY event_type) - 1) % 2 AS INT) AS unit,
         event_id AS row_no, epoch_us(ts) * 1000 - event_id % 5 * 3600000000000 AS ts_ns,
         [{_NAMES}][user_id % 30 + 1] AS symbol, CAST(user_id % 30 AS INT) AS gid, event_id * 7919 % 10007 AS update_id,
         CAST(value AS VARCHAR) AS px, json_extract_string(props, '$.k') AS qty, event_id % 3 AS side
  FROM events)"""
GOOD = TICKS + """,
g AS (SELECT *, gid AS lid, max(ts_ns) OVER (PARTITION BY src ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS merge_ts FROM t WHERE gid < 27)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


FRAC = "rtrim(CASE WHEN strpos({v}, '.') > 0 THEN substr({v}, strpos({v}, '.') + 1) ELSE '' END, '0')"
MANT = "TRY_CAST(split_part({v}, '.', 1) || rpad(left(CASE WHEN strpos({v}, '.') > 0 THEN substr({v}, strpos({v}, '.') + 1) ELSE '' END, {s}), CAST({s} AS INT), '0') AS HUGEINT)"


def frac_length(v: str) -> str:
    return f"length({FRAC.format(v=v)})"


SPOILED = TICKS + """,
s AS (SELECT *, row_no % 83 = 0 AS bad_ts, CASE WHEN row_no % 97 = 0 THEN '6x.8' WHEN row_no % 89 = 0 THEN '-1' ELSE px END AS spx,
             CASE WHEN row_no % 79 = 0 THEN '5000000000' WHEN row_no % 73 = 0 THEN '' ELSE qty END AS sqty FROM t),
r AS (SELECT *, CASE WHEN bad_ts THEN 'bad_ts' WHEN side > 1 THEN 'bad_field' WHEN gid >= 27 THEN 'unknown_symbol' WHEN spx IN ('6x.8', '-1') THEN 'bad_number'
                     WHEN sqty = '' THEN 'bad_number' WHEN sqty = '5000000000' THEN 'scale_overflow' END AS reason FROM s)"""
