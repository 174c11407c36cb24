"""JSON lines: one object a row, with the same keys as CSV columns; prices and quantities are strings.

Lines become VARIANT, so no schema is inferred and a row may have any depth. Types are checked, not coerced: a quoted number
isn't an integer and a number isn't a price.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BAD_FIELD, MALFORMED
from ..functions import fixed
from ..functions.depth import MAX_DEPTH, PROBE, book_depth_column
from .lines import read_lines
from .records import book_records, trade_records


def _objects(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """lines (…, row_no, value) with v: the line's object as a map of variants, null if it isn't an object."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # of repeated keys the last counts
    variant = F.try_parse_json("value")
    is_object = F.schema_of_variant(F.col("_v")).startswith("OBJECT")
    return lines.where(F.col("value") != "").withColumn("_v", variant).withColumn("v", F.when(is_object, F.col("_v").try_cast("map<string,variant>"))).drop("_v")


def _field(key: Column | str) -> Column:
    return F.try_element_at(F.col("v"), F.lit(key) if isinstance(key, str) else key)


def _kind(x: Column) -> Column:
    return F.coalesce(F.schema_of_variant(x), F.lit(""))


def _text(key: Column | str) -> Column:
    """A string value; null if it is missing or anything else."""
    x = _field(key)
    return F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))


def _integer(x: Column) -> Column:
    """A number cut to a whole one; null if it is missing, no number, or beyond 64 bits."""
    return F.when(_kind(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(x, "$", "bigint"))


def json_trades(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """lines (row_no, value; unit and src if there) as trades."""
    lines = lines.withColumns({c: F.lit(0) for c in ("unit", "src") if c not in lines.columns})
    rows = _objects(spark, lines).select(
        "unit", "src", "row_no", F.col("value").alias("raw"), F.col("v").isNull().alias("malformed"), _text("symbol").alias("symbol"), _integer(_field("ts")).alias("ts_ns"),
        _integer(_field("side")).alias("side"), _text("px").alias("px"), _text("qty").alias("qty"),
    )
    missing = F.col("ts_ns").isNull() | F.col("symbol").isNull() | F.col("side").isNull() | F.col("px").isNull() | F.col("qty").isNull()
    out = trade_records(rows, [(MALFORMED, F.col("malformed")), (BAD_FIELD, missing)])
    # A rejected row has no values.
    return out.withColumns({c: F.when(F.col("reason").isNull(), F.col(c)) for c in ("ts_ns", "side", "px", "qty", "price_scale", "qty_scale")})


def json_books(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """lines (row_no, value; unit and src if there) as books, each of its own depth."""
    lines = lines.withColumns({c: F.lit(0) for c in ("unit", "src") if c not in lines.columns})
    keys = F.filter(F.map_keys("v"), lambda k: k.rlike(r"\Abid_px_[1-9][0-9]?\z"))
    levels = F.filter(F.transform(keys, lambda k: F.substring(k, F.lit(8), F.length(k)).cast("int")), lambda k: k <= PROBE)
    depth = book_depth_column(levels)
    uid = _field("update_id")
    number = F.when(_kind(uid) == "STRING", fixed.to_u64(_text("update_id"))).otherwise(F.when(_kind(uid).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(uid, "$", "decimal(38,0)")))
    number = F.when((number >= 0) & (number <= F.lit("18446744073709551615").cast("decimal(38,0)")), number).cast("decimal(20,0)")
    rows = _objects(spark, lines).withColumn("_depth", depth)
    upto = F.sequence(F.lit(0), F.coalesce("_depth", F.lit(1)) - 1)
    # Over literal places, as all keys are known up to MAX_DEPTH, and only as many as the row has.
    side = lambda name: F.slice(F.array(*(_text(name + (f"_{k}" if k else "")) for k in range(MAX_DEPTH))), F.lit(1), F.size(upto))
    rows = rows.select(
        "unit", "src", "row_no", F.col("value").alias("raw"), F.col("v").isNull().alias("malformed"), _text("symbol").alias("symbol"), _integer(_field("ts")).alias("ts_ns"),
        number.alias("update_id"), F.col("_depth").alias("depth"), *[side(n).alias(n) for n in ("bid_px", "bid_qty", "ask_px", "ask_qty")],
    )
    missing = F.col("ts_ns").isNull() | F.col("symbol").isNull() | F.col("depth").isNull() | F.col("update_id").isNull()
    for name in ("bid_px", "bid_qty", "ask_px", "ask_qty"):
        missing = missing | F.exists(name, lambda x: x.isNull())
    return book_records(rows, [(MALFORMED, F.col("malformed")), (BAD_FIELD, missing)])


def read_json(spark: SparkSession, files: Sequence[tuple[int, int, str]], kind: str) -> DataFrame:
    """Records of files (unit, src, path)."""
    lines = read_lines(spark, files)
    return json_books(spark, lines) if kind == "book" else json_trades(spark, lines)
