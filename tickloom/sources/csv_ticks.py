"""CSV ticks: columns by name, any order, extra columns allowed; quoting as in RFC 4180 within one line."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BAD_FIELD, BAD_TS, MALFORMED, Error, ReplayError
from ..functions import fixed
from ..functions.depth import book_depth, highest_level
from .discover import first_line
from .lines import read_lines
from .records import book_records, trade_records

#: Headers that are read at a time.
READERS = 32
#: After each comma (one is put in front of the line): a quoted field with what stands behind its closing quote, a plain
#: field, or nothing. A quote opens a field only as its first character; without a closing quote it takes the rest.
FIELD = r',("[^"]*+(?:""[^"]*+)*+(?:"[^,]*|\z)|[^",][^,]*|)'
QUOTED = r'\A"([^"]*+(?:""[^"]*+)*+)'


def tokenize(line: Column) -> Column:
    """The fields of a line. Lines without a quote, nearly all, take the plain split."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(FIELD), 1)
    unquoted = F.transform(raw, lambda f: F.when(f.startswith('"'), F.replace(F.regexp_extract(f, QUOTED, 1), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(F.contains(line, F.lit('"')), unquoted).otherwise(F.split(line, ",", -1))


def split_line(line: str) -> list[str]:
    """tokenize for one line on the driver: headers."""
    fields = re.findall(FIELD.replace(r"\z", r"\Z"), "," + line)
    return [re.match(QUOTED, f)[1].replace('""', '"') if f.startswith('"') else f for f in fields]


@dataclass(frozen=True)
class Columns:
    """Where the needed fields of a header are. levels: for each level the places of bid_px, bid_qty, ask_px, ask_qty."""

    count: int
    ts: int
    symbol: int
    side: int = -1
    px: int = -1
    qty: int = -1
    update_id: int = -1
    levels: tuple[tuple[int, int, int, int], ...] = ()


def resolve(header: str | None, kind: str) -> Columns:
    """The columns of a header line (None: empty file); of repeated names the first counts."""
    if header is None:
        raise ReplayError(Error.CSV_SCHEMA, "no header")
    names = [n.strip(" \t") for n in split_line(header.removesuffix("\r"))]

    def at(name: str) -> int:
        if name not in names:
            raise ReplayError(Error.CSV_SCHEMA, name)
        return names.index(name)

    common = {"count": len(names), "ts": at("ts"), "symbol": at("symbol")}
    if kind == "trade":
        return Columns(**common, side=at("side"), px=at("px"), qty=at("qty"))
    uid = at("update_id")
    present = lambda k: f"bid_px_{k}" in names
    depth = book_depth(present)
    if depth is None:
        raise ReplayError(Error.BOOK_DEPTH_UNSUPPORTED, f"{highest_level(present) + 1} levels")
    suffixes = ["", *(f"_{k}" for k in range(1, depth))]
    return Columns(**common, update_id=uid, levels=tuple(tuple(at(f + s) for f in ("bid_px", "bid_qty", "ask_px", "ask_qty")) for s in suffixes))


def parsed(lines: DataFrame, columns: Columns, kind: str) -> DataFrame:
    """Lines (unit, src, row_no, value) of files with one layout, header and empty lines left out, as records."""
    rows = lines.where((F.col("row_no") > 0) & (F.col("value") != "")).withColumn("f", tokenize(F.col("value")))
    field = lambda i: F.get("f", F.lit(i))
    common = [F.col(c) for c in ("unit", "src", "row_no")] + [F.col("value").alias("raw"), F.size("f").alias("n"), field(columns.symbol).alias("symbol"), fixed.to_i64(field(columns.ts)).alias("ts_ns")]
    before = [(MALFORMED, F.col("n") != columns.count), (BAD_TS, F.col("ts_ns").isNull())]
    if kind == "trade":
        out = rows.select(*common, fixed.to_i64(field(columns.side)).alias("side"), field(columns.px).alias("px"), field(columns.qty).alias("qty"))
        return trade_records(out, before)
    sides = [F.array(*(field(level[i]) for level in columns.levels)).alias(name) for i, name in enumerate(("bid_px", "bid_qty", "ask_px", "ask_qty"))]
    out = rows.select(*common, fixed.to_u64(field(columns.update_id)).alias("update_id"), F.lit(len(columns.levels)).alias("depth"), *sides)
    return book_records(out, [*before, (BAD_FIELD, F.col("update_id").isNull())])


def usable(spark: SparkSession, paths: Sequence[str], kind: str) -> tuple[list[tuple[str, Columns]], list[tuple[str, ReplayError]]]:
    """Files with a good header and their columns; files to be skipped and why. READERS first lines are fetched at a time, and
    nothing else of the files."""

    def of(path: str) -> Columns | ReplayError:
        try:
            return resolve(first_line(spark, path), kind)
        except ReplayError as e:
            return e

    with ThreadPoolExecutor(READERS) as pool:
        found = list(zip(paths, pool.map(of, paths)))
    return [(p, c) for p, c in found if isinstance(c, Columns)], [(p, e) for p, e in found if isinstance(e, ReplayError)]


def read_csv(spark: SparkSession, files: Sequence[tuple[int, int, str, Columns]], kind: str) -> DataFrame:
    """Records of files (unit, src, path, columns): one scan for each distinct layout."""
    layouts: dict[Columns, list[tuple[int, int, str]]] = {}
    for unit, src, path, columns in files:
        layouts.setdefault(columns, []).append((unit, src, path))
    out = None
    for columns, own in layouts.items():
        part = parsed(read_lines(spark, own), columns, kind)
        out = part if out is None else out.unionByName(part)
    return out
