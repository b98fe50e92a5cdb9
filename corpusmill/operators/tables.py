"""Tables that cut lineage and survive lost executors, and places of rows in an order that no task sees whole."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_CHECKPOINT = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Texts and files are long rows, and a Python task holds a batch several times: batches end after `rows` rows or `size` bytes (a
    longer row is one of its own). Smaller settings of the session's own stay."""
    for name, most in ((_BATCH, rows), (_BATCH_BYTES, size)):
        now = int(str(spark.conf.get(name)).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def give_back() -> None:
    """At the end of a task: returns what its Python worker has freed to the system, as workers live on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only under a local master that has none."""
    found = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getConf().get(_CHECKPOINT)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set(_CHECKPOINT, found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, kind: str = "files") -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: a lost executor costs a reread only."""
    spark = df.sparkSession
    path = new_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes what `written` made, once nothing reads it any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("table-"):
                deleted(df.sparkSession, folder)


def placed(rows: DataFrame, group: list[str], order: list[str], value: Column | None = None) -> DataFrame:
    """`rows`, written, with `_g` (the group as one string, nulls too), `_i` (the place in the group, from 0) and, if a
    `value` is given, `_before` (the sum of it over the rows before this one in the group).

    Rows are sorted by range over group and order, so a hot group lies in many tasks. Each task numbers its own rows;
    what comes before them is a running sum over one row for each task and group."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    laid = rows.withColumns({"_g": key, "_v": (value if value is not None else F.lit(0)).cast("long"), "_salt": F.monotonically_increasing_id()})
    # The last order column only parts rows that are equal in all others.
    laid = laid.repartitionByRange(tasks, "_g", *order, "_salt").sortWithinPartitions("_g", *order, "_salt")
    # The upper bits of the number are the task, the lower 33 the row in it.
    laid = written(laid.drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumns({"_task": F.shiftrightunsigned("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    whole = Window.partitionBy("_g").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("_g", "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"), F.sum("_v").alias("_sum"))
    parts = parts.select("_g", "_task", (F.coalesce(F.sum("_rows").over(whole), F.lit(0)) - F.col("_first")).alias("_shift"), F.coalesce(F.sum("_sum").over(whole), F.lit(0)).alias("_above"))
    out = laid.join(parts, ["_g", "_task"]).withColumn("_i", F.col("_row") + F.col("_shift"))
    if value is not None:
        inside = Window.partitionBy("_g", "_task").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_before", F.col("_above") + F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return out.drop("_at", "_task", "_row", "_v", "_shift", "_above")
