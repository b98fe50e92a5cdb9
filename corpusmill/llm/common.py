"""What the operators share: reading tables, writing tables that survive lost executors, ranks."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid

import pyarrow
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_CHECKPOINT = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long rows: Arrow batches of Spark's 10,000 would hold tens of MB in each task, in the JVM and
    again in Python. A smaller setting of the session's own stays."""
    if int(spark.conf.get(_BATCH)) > rows:
        spark.conf.set(_BATCH, str(rows))


def give_back() -> None:
    """At the end of a task: returns what its Python worker has freed to the system, as workers live on."""
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is configured."""
    found = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getConf().get(_CHECKPOINT)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set(_CHECKPOINT, found)
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Writes `df` as Parquet in the shared folder and reads it again: lineage ends here, and any
    lost executor costs only a reread. The reader's schema is given, so an empty table keeps it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of tables made by `written` that nothing will read any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getName().startswith("table-"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hash_bucket(hashed: str, buckets: int) -> Column:
    """The longs cut into `buckets` equal ranges, numbered in their (unsigned) order."""
    return F.shiftright(F.shiftrightunsigned(hashed, 33) * F.lit(buckets), 31)


def hottest(df: DataFrame, group: list[str]) -> int:
    """Rows of the largest group."""
    return df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def running(df: DataFrame, group: list[str], bucket: Column, order: list[Column | str], value: Column | str, into: str) -> DataFrame:
    """Adds `into`: the sum of `value` over the rows before this one in its group, in the order of
    `bucket` and then of `order`. `group` must hold no nulls.

    A window over a hot group would be one task. Here each bucket of a group is summed on its own;
    the sums of the buckets, one row for each, give what precedes them."""
    value = F.col(value) if isinstance(value, str) else value
    cut = df.withColumns({"_v": value, "_b": bucket})
    sums = cut.groupBy(*group, "_b").agg(F.sum("_v").alias("_s"))
    above = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "_b", F.coalesce(F.sum("_s").over(above), F.lit(0)).alias("_above"))
    inside = Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return cut.join(sums, [*group, "_b"]).withColumn(into, F.col("_above") + F.col("_inside")).drop("_v", "_b", "_inside", "_above")
