"""What several operators share: the shared folder, written intermediate tables, small expressions, bounded collects."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The bytes 0x20 and 0x09-0x0D.
BLANKS = " \t\n\x0b\f\r"


#: Writer options for tables whose rows may be megabytes: row groups of 32 MB, sizes looked at from the first row on.
LARGE_ROWS = {"parquet.block.size": str(32 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "100", "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "100"}

#: Bytes of an Arrow batch between the JVM and Python, beyond single longer rows; a batch is held several times on both sides.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which driver and executors share; a new one where none is set (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="tickloom-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_folders: dict[str, SparkSession] = {}

#: Shuffle files go when the query that wrote them ends, and not when the driver's collector happens to find them unused.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: its lineage ends there, so a lost executor costs no recomputation.
    The folder goes when it is removed() or the driver ends, the shuffle files of the write at its end."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    _folders[path] = spark
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, column: str) -> DataFrame:
    """df with a long in column that numbers its rows, the same however often they are read. Rows of Parquet files are numbered
    by file and place, so such a table isn't copied; anything else is written once."""
    plan = df._jdf.queryExecution().analyzed()
    name = lambda x: x.getClass().getSimpleName()
    if name(plan) != "LogicalRelation" or name(plan.relation()) != "HadoopFsRelation" or name(plan.relation().fileFormat()) != "ParquetFileFormat" or "_metadata" in map(str.lower, df.columns):
        return written(df.withColumn(column, F.monotonically_increasing_id()), "rows")
    at, path, number = fresh(df.withColumn(column, F.lit(0)), "at", "path", "number")
    paths = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
    files = df.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), f"{path} string, {number} long")
    told = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(at)).join(F.broadcast(files), path)
    return told.select(*df.columns, (F.shiftleft(number, 33) + F.col(at)).alias(column))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table that written() returned and nothing reads any more."""
    for folder in _of(df):
        _delete(df.sparkSession, folder)
        _folders.pop(folder, None)


def _of(df: DataFrame) -> set[str]:
    """The folders of written() that df reads."""
    read = {f.rsplit("/", 1)[0].split("://")[-1].removeprefix("file:") for f in df.inputFiles()}
    return {f for f in _folders if f.split("://")[-1].removeprefix("file:") in read}


def tables() -> set[str]:
    """The folders that written() has made so far."""
    return set(_folders)


def kept_only(df: DataFrame, before: set[str]) -> None:
    """Deletes what written() has made since `before` was taken from tables(), except the table df."""
    for folder in set(_folders) - before - _of(df):
        _delete(df.sparkSession, folder)
        _folders.pop(folder, None)


@atexit.register
def _clear() -> None:
    for folder, spark in _folders.items():
        if spark.sparkContext._jsc is None:
            return  # stopped already; what is left is the shared folder's owner's to clear
        try:
            _delete(spark, folder)
        except Exception:  # the session may be going down at the same time
            return


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow(function, schema) over batches of BATCH_BYTES, unless the session says how large they are. At a task's end
    the worker, which serves many tasks after it, gives back the memory that it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    conf = df.sparkSession.conf
    if not conf._jconf.contains(BATCH_SETTING):
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the fast built-in serves texts of one byte a character."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that df doesn't have, whatever extra columns it carries."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        name = f"_{base}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def fits(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows; reads no more than it needs to know."""
    return df.limit(limit + 1).count() <= limit
