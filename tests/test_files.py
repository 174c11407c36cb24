"""Chunks from the data, times as columns, batches that run again, outputs that fail: what the queries' tables can't show."""

import logging

import pytest
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import boards
from tickloom.operators.scans import bounds_of, chunk_by
from tickloom.operators.segments import Segments
from tickloom.plans import catalog_files, replay
from tickloom.plans.config import Config, Input, Output, Replay
from tickloom.streaming.paced import PacedReplay

SF = "/root/testdata/sf0.001"


def test_chunks_follow_the_data(spark):
    """An hour with a third of its rows in one second: chunks of about equal rows, in order."""
    rows = spark.range(30_000).select((F.when(F.col("id") % 3 == 0, 1_000_000_000 + F.col("id")).otherwise(F.col("id") * 120_000_000)).alias("t"))
    bounds = bounds_of(rows, "t", least=16)
    sizes = {r.c: r.n for r in rows.groupBy(chunk_by(bounds, F.col("t")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(sizes) >= 15 and max(sizes.values()) < 2 * 30_000 / 16
    plain = [sum(b <= t for b in bounds) for (t,) in rows.collect()]
    assert [r.c for r in rows.select(chunk_by(bounds, F.col("t")).alias("c")).collect()] == plain
    assert bounds_of(rows.limit(0), "t") == [] and bounds_of(rows.limit(1), "t") == []


def test_one_hot_symbol_of_an_hour_is_many_even_tasks(spark):
    rows = spark.range(20_000).select(F.lit(0).alias("unit"), F.lit(0).alias("src"), F.col("id").alias("row_no"), (F.col("id") * 180_000_000).alias("ts_ns"), (F.col("id") * 180_000_000).alias("merge_ts"), F.lit(19).alias("lid"), (F.col("id") * 7919 % 10007).alias("update_id"))
    chunk = chunk_by(bounds_of(rows, "ts_ns", least=16), F.col("merge_ts"))
    sizes = [r.n for r in rows.groupBy(chunk.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 1.5 * 20_000 / len(sizes)
    same = [boards.claim(rows, ["lid"], chunk=c).where("accepted").select("row_no") for c in (chunk, None)]
    assert sorted(same[0].collect()) == sorted(same[1].collect())


@pytest.mark.parametrize("text", ["2024-01-02 03:04:05", "2024-1-2 3:4:5", " 2024- 1- 2 3: 4: 5", "2024-02-30 00:00:00", "2024-01-01 00:00:60", "2024-01-01 24:00:00", "2024-01-02 03:04:05Z", "1969-12-31 23:59:59", "1969-12-31 23:59:58", "", "17", "-17", "x", "2024-01-01"])
def test_datetime_column_is_the_function(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(times.datetime_ns(F.col("t")).alias("d"), times.ts_value_ns(F.col("t")).alias("v")).first()
    plain = times.parse_datetime_ns(text, 0)
    assert row.d == (None if text == "" else plain) and row.v == times.parse_ts_value(text)


def trade_unit(spark, root):
    folder = catalog_files.tick_files(catalog_files.trade_lines(spark, SF), f"{root}/ticks", ".trade.csv")
    return Replay(Input("csv", folder, "trade"), Output("log", True))


def test_a_batch_that_runs_again_publishes_nothing_twice(spark, tmp_path):
    """A batch whose rows are written but whose end isn't told runs again, as does a whole driver over the same journal."""
    cfg = Config(realtime=1e-7, replays=(trade_unit(spark, tmp_path),), progress_sec=0)
    player = PacedReplay(spark, cfg, f"{tmp_path}/out", f"{tmp_path}/work")
    half = player.end // 2
    player.deliver(0, half)
    head = player.segments.head("log")
    player.deliver(0, half)
    assert player.segments.head("log") == head > 0 and player.segments.batch("log") == 0
    other = PacedReplay(spark, cfg, f"{tmp_path}/out", f"{tmp_path}/work")
    assert other.journal.last() == 0
    other.play()
    want = replay.run(spark, Config(realtime=0.0, replays=cfg.replays), f"{tmp_path}/whole").trade
    assert other.segments.head("log") == want > head and other.journal.last() == -1


def test_an_output_that_cannot_be_written_is_counted(spark, tmp_path, caplog):
    unit = trade_unit(spark, tmp_path)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "log").write_text("a file")
    with caplog.at_level(logging.INFO, "tickloom"):
        report = replay.run(spark, Config(realtime=0.0, replays=(unit,)), str(tmp_path / "out"))
    assert report.trade == 0 and report.failed[0] > 0 and any("could not be written" in line for line in report.lines())
    assert Segments(spark, str(tmp_path / "out")).versions("log") == []
