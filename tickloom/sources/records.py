"""From fields to records: symbols, fixed-point encoding and the reason for which a row is rejected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import BAD_FIELD, BAD_NUMBER, SCALE_OVERFLOW, UNKNOWN_SYMBOL
from ..functions import fixed
from ..functions.symbols import gid_of
from ..operators.boards import padded_levels
from ..operators.rejects import first_reason

BOOK = ["unit", "src", "row_no", "reason", "symbol", "raw", "ts_ns", "update_id", "lid", "depth", "price_scale", "qty_scale", "bid_px", "bid_qty", "ask_px", "ask_qty"]
TRADE = ["unit", "src", "row_no", "reason", "symbol", "raw", "ts_ns", "gid", "side", "price_scale", "qty_scale", "px", "qty"]


def _failures(group: Column) -> list[tuple[str, Column]]:
    return [(BAD_NUMBER, group["status"] == fixed.BAD_NUMBER), (SCALE_OVERFLOW, group["status"] == fixed.SCALE_OVERFLOW)]


def encoded(rows: DataFrame, prices: Column, quantities: Column, before: list[tuple[str, Column]], fields: Callable[[Column, Column], dict[str, Column]]) -> DataFrame:
    """rows with reason, price_scale, qty_scale and fields(prices' group, quantities' group). Checks in `before` come first.

    All of it is one struct made by a generator, in which each group is encoded once. As plain columns, a filter on reason
    would be pushed below the projection and encode every group again for each check.
    """

    def made(px: Column, qty: Column) -> Column:
        reason = first_reason([*before, *_failures(px), *_failures(qty)]).alias("reason")
        return F.struct(reason, px["scale"].alias("price_scale"), qty["scale"].alias("qty_scale"), *[v.alias(k) for k, v in fields(px, qty).items()])

    one = fixed.let(fixed.encode_group(prices), lambda px: fixed.let(fixed.encode_group(quantities), lambda qty: made(px, qty)))
    return rows.select("*", F.inline(F.array(one)))


def book_records(rows: DataFrame, before: list[tuple[str, Column]]) -> DataFrame:
    """rows (unit, src, row_no, raw, symbol, ts_ns, update_id, depth, and arrays bid_px, bid_qty, ask_px, ask_qty of texts) as
    BOOK. All prices share a scale, all quantities another."""
    sides = ["bid_px", "bid_qty", "ask_px", "ask_qty"]
    rows = rows.withColumn("lid", gid_of(F.col("symbol")))
    part = lambda group, first: F.slice(group["mantissas"], F.lit(1) if first else F.col("depth") + 1, F.col("depth"))
    fields = lambda px, qty: {"m_bid_px": part(px, True), "m_bid_qty": part(qty, True), "m_ask_px": part(px, False), "m_ask_qty": part(qty, False)}
    out = encoded(rows, F.concat("bid_px", "ask_px"), F.concat("bid_qty", "ask_qty"), [*before, (UNKNOWN_SYMBOL, F.col("lid").isNull())], fields)
    good = F.col("reason").isNull()
    return padded_levels(out.withColumns({c: F.when(good, F.col(f"m_{c}")) for c in sides})).select(*BOOK)


def trade_records(rows: DataFrame, before: list[tuple[str, Column]]) -> DataFrame:
    """rows (unit, src, row_no, raw, symbol, ts_ns, side, and texts px, qty) as TRADE; px and qty have scales of their own."""
    rows = rows.withColumn("gid", gid_of(F.col("symbol")))
    side = F.col("side").isNull() | ~F.col("side").isin(0, 1)
    first = lambda group: F.get(group["mantissas"], F.lit(0))
    checks = [*before, (BAD_FIELD, side), (UNKNOWN_SYMBOL, F.col("gid").isNull())]
    out = encoded(rows, F.array("px"), F.array("qty"), checks, lambda px, qty: {"m_px": first(px), "m_qty": first(qty)})
    return out.withColumns({"px": F.col("m_px"), "qty": F.col("m_qty")}).select(*TRADE)
