"""Replay at a pace, as a Structured Streaming query.

A rate source is the clock. Each micro-batch covers a stretch of wall time since the start; the rows due in it, at
(ts - ts0) * realtime, go to the units' segments. The stretch of a batch is written down before its rows are, so a batch that
runs again after a failure covers the same rows, and attaching to a segment drops what is there already by update id. The
targets are absolute: a slow batch doesn't shift later ones. Order and content are exact; timing is as fine as micro-batches.
A segment's header tells the last batch in it, so trades aren't published twice either. A driver that died is followed by one
that finds the journal under the job's name and goes on behind its last batch; a replay that ended removes it.
"""

from __future__ import annotations

import json
import logging
import signal
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import offset_ns
from ..operators.segments import Segments
from ..operators.stored import deleted
from ..plans.config import Config
from ..plans.replay import Report, Unit, emitted, load, skips, write_unit

log = logging.getLogger("tickloom")


class Stopper:
    """Set by SIGINT and SIGTERM; a replay ends after the running batch."""

    def __init__(self):
        self.event = threading.Event()

    def install(self) -> Stopper:
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, lambda *_: self.event.set())
        return self

    def requested(self) -> bool:
        return self.event.is_set()


class Journal:
    """The stretch of wall time (nanoseconds since the start) of each batch, in a folder that Spark can write."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _file(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def get(self, batch: int) -> dict | None:
        store, path = self._file(f"{batch}.json")
        if not store.exists(path):
            return None
        return json.loads(self.spark.read.text(path.toString(), wholetext=True).first().value)

    def last(self) -> int:
        """The last batch written down, -1 if none."""
        store, path = self._file("")
        if not store.exists(path):
            return -1
        names = [s.getPath().getName() for s in store.listStatus(path)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=-1)

    def clear(self) -> None:
        store, path = self._file("")
        store.delete(path, True)

    def put(self, batch: int, entry: dict) -> None:
        store, part = self._file(f".{batch}.part")
        stream = store.create(part, True)
        try:
            stream.write(bytearray(json.dumps(entry).encode()))
        finally:
            stream.close()
        store.rename(part, self._file(f"{batch}.json")[1])


class PacedReplay:
    """Rows of all units with due times, delivered stretch by stretch."""

    def __init__(self, spark: SparkSession, cfg: Config, root: str, work: str):
        self.spark, self.cfg, self.segments = spark, cfg, Segments(spark, root)
        self.journal = Journal(spark, f"{work}/journal")
        self.work, self.report, self.last_log = work, Report(), time.monotonic()
        self.units = load(spark, cfg)
        rows = {u.number: emitted(u) for u in self.units}
        firsts = [r.agg(F.min("merge_ts")).first()[0] for r in rows.values()]
        self.ts0 = cfg.init_ts if cfg.init_ts is not None else min((t for t in firsts if t is not None), default=0)
        self.rows: dict[int, DataFrame] = {}
        for number, df in rows.items():
            # Due times follow merge_ts, in which rows leave the merge; written sorted, so a stretch reads few row groups.
            due = df.withColumn("due_ns", offset_ns(F.col("merge_ts"), self.ts0, cfg.realtime))
            due.repartitionByRange("due_ns").sortWithinPartitions("due_ns").write.mode("overwrite").parquet(f"{work}/due/{number}")
            self.rows[number] = spark.read.parquet(f"{work}/due/{number}")
        ends = [r.agg(F.max("due_ns")).first()[0] for r in self.rows.values()]
        self.end = max((t for t in ends if t is not None), default=-1)

    def deliver(self, batch: int, now_ns: int) -> bool:
        """Delivers what is due up to now_ns and wasn't yet; whether all is delivered."""
        before = self.journal.get(batch - 1) if batch else None
        entry = self.journal.get(batch)
        if entry is None:
            entry = {"after": before["to"] if before else -1, "to": max(now_ns, before["to"] if before else 0)}
            self.journal.put(batch, entry)
        for unit in self.units:
            due = self.rows[unit.number].where((F.col("due_ns") > entry["after"]) & (F.col("due_ns") <= entry["to"]))
            if batch == 0 or not due.isEmpty():
                self._write(unit, due.drop("due_ns"), batch == 0 and unit.plan.output.create, batch)
        if self.cfg.progress_sec > 0 and time.monotonic() - self.last_log >= self.cfg.progress_sec:
            at = self.ts0 + int(entry["to"] / (self.cfg.realtime or 1))
            log.info("at %d ns of the data: %d quotes, %d trades, %.0f rows a second", at, self.report.book, self.report.trade, self.report.events_per_sec())
            self.last_log = time.monotonic()
        return entry["to"] >= self.end

    def _write(self, unit: Unit, rows: DataFrame, create: bool, batch: int) -> None:
        n, extra = write_unit(unit, rows, self.segments, create, batch)
        if unit.layout == "trade":
            self.report.trade += n
        else:
            self.report.book += n
            self.report.deduped[unit.number] = self.report.deduped.get(unit.number, 0) + extra

    def play(self, stopper: Stopper | None = None) -> Report:
        """To the end or until stopped: at once for realtime 0, else by the clock."""
        try:
            if self.cfg.realtime == 0:
                self.deliver(0, max(0, self.end))
            else:
                self._stream(stopper or Stopper())
            self.report.skipped, self.report.unknown = skips(self.units)
            self.journal.clear()
        finally:
            for unit in self.units:
                deleted(self.spark, unit.folder)
        for line in self.report.lines():
            log.info(line)
        return self.report

    def _stream(self, stopper: Stopper) -> None:
        done, start = threading.Event(), {}

        def on_batch(clock: DataFrame, batch: int) -> None:
            now = clock.agg(F.max(F.unix_micros("timestamp"))).first()[0]
            if now is None or done.is_set() or stopper.requested():
                return
            # The last batch written down may not have been delivered whole: it comes first, with the stretch it had.
            number = start.setdefault("batches", max(0, self.journal.last()))
            before = self.journal.get(number - 1) if number else None
            zero = start.setdefault("zero", now - (before["to"] // 1000 if before else 0))
            if self.deliver(number, (now - zero) * 1000):
                done.set()
            start["batches"] = number + 1

        clock = self.spark.readStream.format("rate").option("rowsPerSecond", 10).load()
        query = clock.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{self.work}/checkpoint").trigger(processingTime="100 milliseconds").start()
        try:
            while query.isActive and not done.is_set() and not stopper.requested():
                query.awaitTermination(0.1)
            if query.exception():
                raise query.exception()
        finally:
            query.stop()
