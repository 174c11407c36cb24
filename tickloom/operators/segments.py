"""Output tables: boards of latest values and trade logs, with a header that says what they are.

A segment is a folder with numbered versions. A version's header is written after its rows, so a reader takes the highest
version with a header and never sees half a write; a run adds a version and clears away those before the last. Nothing in it
depends on the clock of the machine, so equal input gives equal rows.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import Error, ReplayError, SegmentState
from ..functions.schema_hash import BOARD, LAYOUT_VERSION, LAYOUTS, MAGIC, RING, RING_CAPACITY, schema_fnv
from ..functions.symbols import SYMBOLS
from . import ring


@dataclass(frozen=True)
class Header:
    magic: int
    layout_version: int
    kind: int
    entry_size: int
    capacity: int
    schema_hash: str  # unsigned 64 bits in hexadecimal
    created_ns: int = 0


#: What each table is: kind, bytes of an entry in the layout described, entries, hash of the description.
HEADERS = {
    "bbo": Header(MAGIC, LAYOUT_VERSION, BOARD, 64, len(SYMBOLS), f"{schema_fnv(LAYOUTS['bbo']):016x}"),
    "depth": Header(MAGIC, LAYOUT_VERSION, BOARD, 448, len(SYMBOLS), f"{schema_fnv(LAYOUTS['depth']):016x}"),
    "trade": Header(MAGIC, LAYOUT_VERSION, RING, 64, RING_CAPACITY, f"{schema_fnv(LAYOUTS['trade']):016x}"),
}
BBO_FIELDS = ["bid_px", "bid_qty", "ask_px", "ask_qty", "price_scale", "qty_scale"]
DEPTH_FIELDS = ["depth", *BBO_FIELDS]
TRADE_FIELDS = ["exch_ns", "px", "qty", "gid", "side", "price_scale", "qty_scale"]


def segment_bytes(layout: str) -> int:
    """Bytes that a segment of this layout takes as a memory image: a header and aligned lines of 64 bytes. Boards keep an
    8-byte id for each slot besides, logs a line with their head."""
    h = HEADERS[layout]
    rest = 8 * h.capacity if h.kind == BOARD else 64
    return -(-(64 + h.entry_size * h.capacity + rest) // 64) * 64


def segment_check(found: Header, want: Header) -> SegmentState:
    """The first difference, in order of weight; a different field description alone is drift, which may be let pass."""
    for differs, state in (
        (found.magic != want.magic, SegmentState.BAD_MAGIC),
        (found.layout_version != want.layout_version, SegmentState.BAD_VERSION),
        (found.kind != want.kind, SegmentState.BAD_KIND),
        ((found.entry_size, found.capacity) != (want.entry_size, want.capacity), SegmentState.SIZE_MISMATCH),
        (found.schema_hash != want.schema_hash, SegmentState.SCHEMA_DRIFT),
    ):
        if differs:
            return state
    return SegmentState.OK


class Segments:
    """The segments under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self, name: str) -> list[int]:
        """Complete versions, oldest first."""
        store, path = self._path(name.strip("/"))
        if not store.exists(path):
            return []
        numbers = [int(s.getPath().getName()) for s in store.listStatus(path) if s.getPath().getName().isdigit()]
        done = lambda v: (lambda s, p: s.exists(p))(*self._path(name.strip("/"), str(v), "header", "_SUCCESS"))
        return sorted(v for v in numbers if done(v))

    def _read(self, name: str, what: str) -> DataFrame:
        found = self.versions(name)
        if not found:
            raise ReplayError(Error.SEGMENT_OPEN, f"no segment {name!r}")
        return self.spark.read.parquet(f"{self.root}/{name.strip('/')}/{found[-1]}/{what}")

    def header(self, name: str) -> Header:
        row = self._read(name, "header").first()
        return Header(**{f.name: row[f.name] for f in fields(Header)})

    def read(self, name: str) -> DataFrame:
        """The rows of the last complete version: a snapshot, whatever is written meanwhile."""
        return self._read(name, "rows")

    def head(self, name: str) -> int:
        """Trades ever published to a log."""
        return self._read(name, "header").first().head

    def batch(self, name: str) -> int:
        """The last batch of a paced replay that is in a segment; -1 if none wrote it."""
        return self._read(name, "header").first().batch

    def drain(self, name: str, after: int) -> tuple[DataFrame, int, int]:
        """Trades of a log from slot `after` on, the number overwritten unread, and where to read on."""
        return ring.drain(self.read(name), after, self.head(name), self.header(name).capacity)

    def checked(self, name: str, layout: str) -> SegmentState:
        """The state of an existing segment; any but OK and drift is an error."""
        state = segment_check(self.header(name), HEADERS[layout])
        if state not in (SegmentState.OK, SegmentState.SCHEMA_DRIFT):
            raise ReplayError(Error.SEGMENT_MISMATCH, f"{name}: {state.value}")
        return state

    def _write(self, name: str, layout: str, rows: DataFrame, head: int, batch: int = -1, header: Header | None = None) -> None:
        own = name.strip("/")
        store, path = self._path(own)
        tried = [int(s.getPath().getName()) for s in store.listStatus(path) if s.getPath().getName().isdigit()] if store.exists(path) else []
        version = max(tried, default=0) + 1
        rows.write.parquet(f"{self.root}/{own}/{version}/rows")
        line = self.spark.createDataFrame([{**asdict(header or HEADERS[layout]), "head": head, "batch": batch}], "magic long, layout_version int, kind int, entry_size int, capacity int, schema_hash string, created_ns long, head long, batch long")
        line.coalesce(1).write.parquet(f"{self.root}/{own}/{version}/header")
        for old in tried:
            if old < version - 1:
                store.delete(self._path(own, str(old))[1], True)

    def write_board(self, name: str, layout: str, new: DataFrame, create: bool = True, batch: int = -1) -> None:
        """A board of all symbols, zero where nothing was written. new: rows of boards.board() by lid, claimed against best()
        unless create. Attaching keeps slots that got nothing and counts seq on."""
        wanted = BBO_FIELDS if layout == "bbo" else DEPTH_FIELDS
        zero = {f: F.lit(0).cast("bigint") if layout == "bbo" or f in ("price_scale", "qty_scale", "depth") else F.array_repeat(F.lit(0).cast("bigint"), 25) for f in wanted}
        columns = ["seq", "exch_ns", "update_id", *wanted, "best_uid"]
        kinds = {"update_id": "decimal(20,0)", "best_uid": "decimal(20,0)", "price_scale": "int", "qty_scale": "int", "depth": "int", "seq": "bigint", "exch_ns": "bigint"}
        slots = self.spark.range(len(SYMBOLS)).select(F.col("id").cast("int").alias("lid"))
        new = new.select("lid", *[F.col(c).alias(f"_{c}") for c in columns])
        out = slots.join(new, "lid", "left")
        if create or not self.versions(name):
            old = {c: zero.get(c, F.lit(0)) for c in columns}
        else:
            self.checked(name, layout)
            out = out.join(self.read(name).drop("symbol_lid", "path_idx", "kernel_t", "shm_t", "e_t"), "lid", "left")
            old = {c: F.coalesce(c, zero.get(c, F.lit(0))) for c in columns}
        picked = [F.when(F.col("_seq").isNull(), old[c]).otherwise(F.col(f"_{c}") + old[c] if c == "seq" else F.col(f"_{c}")) for c in columns]
        rows = out.select("lid", *[(p.cast(kinds[c]) if c in kinds else p).alias(c) for c, p in zip(columns, picked)])
        rows = rows.select("*", F.when(F.col("seq") > 0, F.col("lid")).otherwise(0).alias("symbol_lid"))
        if layout == "bbo":  # latencies and path are those of live feeds
            rows = rows.withColumns({"kernel_t": F.lit(0), "shm_t": F.lit(0), "e_t": F.lit(0), "path_idx": F.lit(0)})
        self._write(name, layout, rows.orderBy("lid"), 0, batch)

    def best(self, name: str) -> DataFrame:
        """(lid, best_uid) of an existing board."""
        return self.read(name).where("best_uid > 0").select("lid", "best_uid")

    def write_trades(self, name: str, trades: DataFrame, create: bool = True, batch: int = -1) -> int:
        """A log's last entries. trades: one unit's, in merge order columns. Attaching goes on at the existing head. Returns
        the trades published by this call."""
        capacity = HEADERS["trade"].capacity
        count = trades.count()
        old, first = None, 0
        if not create and self.versions(name):
            self.checked(name, "trade")
            old, first = self.read(name), self.head(name)
        unit = trades.select(F.lit(0).alias("unit"), *[c for c in trades.columns if c != "unit"])
        last = ring.tail(unit, [0], capacity).withColumn("slot", F.col("slot") + first)
        if old is not None:
            last = last.unionByName(old, allowMissingColumns=True).where(F.col("slot") >= first + count - capacity)
        rows = last.select("slot", (F.col("slot") % capacity).cast("int").alias("ring_idx"), (2 * F.col("slot")).alias("seq"), *TRADE_FIELDS)
        self._write(name, "trade", rows.orderBy("slot"), first + count, batch)
        return count
