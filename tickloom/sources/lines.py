"""Text lines of many files with their place, from one scan that splits large files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scans import position


def read_lines(spark: SparkSession, files: Sequence[tuple[int, int, str]]) -> DataFrame:
    """(unit, src, row_no, value) of files (unit, src, path): lines end at "\\n", one "\\r" before it is dropped; row_no counts
    all lines of a file from 0, empty ones too.

    A file's splits are numbered by where they begin and rows inside a split by reading order, so a file of any size is
    numbered by many tasks: blocks are counted, and each gets the count of those before it.
    """
    lines = spark.read.option("lineSep", "\n").text([p for _, _, p in files]).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    names = spark.createDataFrame([(u, s, p) for u, s, p in files], "unit int, src int, path string")
    # The same path may be written file:/x or file:///x; both sides are cut to scheme-free form.
    bare = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/*", "/")
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/*", "/")
    met = lines.join(F.broadcast(names), bare(F.col("_path")) == plain(F.col("path")))
    numbered = position(met, ["unit", "src"], ["_id"], "row_no", F.col("_block"))
    return numbered.select("unit", "src", "row_no", F.regexp_replace("value", "\r\\z", "").alias("value"))
