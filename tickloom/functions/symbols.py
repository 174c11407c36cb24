"""The symbol dimension: 27 names whose places are ids that outputs carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A symbol's id is its place.
SYMBOLS = [
    "AAVEUSDT", "ADAUSDT", "APTUSDT", "ARBUSDT", "AVAXUSDT", "AXSUSDT", "BCHUSDT", "BNBUSDT", "CRVUSDT",
    "DOGEUSDT", "DOTUSDT", "ENSUSDT", "HBARUSDT", "LTCUSDT", "OPUSDT", "ORDIUSDT", "PEOPLEUSDT", "PNUTUSDT",
    "SANDUSDT", "SOLUSDT", "SUIUSDT", "TIAUSDT", "TRUMPUSDT", "UNIUSDT", "WLDUSDT", "XLMUSDT", "XRPUSDT",
]


def gid_of(symbol: Column) -> Column:
    """The id of a name (exact match), null if unknown: a literal map, so rows stay where they are."""
    return F.try_element_at(F.create_map(*[x for i, name in enumerate(SYMBOLS) for x in (F.lit(name), F.lit(i))]), symbol)


def to_gid(lid: Column) -> Column:
    """Local ids are global ids; -1 outside the table."""
    return F.when(lid.between(0, len(SYMBOLS) - 1), lid).otherwise(F.lit(-1))


def symbol_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SYMBOLS)), "gid int, symbol string")
