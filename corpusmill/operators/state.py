"""Ingestion state without updates: an append-only log of status events, and views over it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOG = "seq long, file_path string, file_hash string, event string, chunks int, error string, run_id string, ts double"
INDEX = "seq_id long, file_path string, file_hash string, file_size long, indexed_at double"
RUNS = "run_id string, started_at double, finished_at double, total_files long"
CHECKPOINTS = "key string, value string, updated_at double"


def numbered(df: DataFrame, key: str, into: str, after: int = 0) -> DataFrame:
    """Numbers rows from after + 1 on, in the order of md5(key) and then key. A row's number is what its
    bucket of hashes begins with plus its place there, so no task sees all rows."""
    h = df.withColumns({"_h": F.md5(key), "_b": F.substring(F.md5(key), 1, 3)})
    counts = h.groupBy("_b").count()
    before = counts.select("_b", F.coalesce(F.sum("count").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    return h.withColumn("_place", place).join(F.broadcast(before), "_b").withColumn(into, F.col("_before") + F.col("_place") + F.lit(after)).drop("_h", "_b", "_before", "_place")


def index_additions(files: DataFrame, index: DataFrame, at: float) -> DataFrame:
    """Rows to append to `index` for the paths of `files` (path, length, file_hash) that it lacks."""
    last = index.agg(F.max("seq_id")).first()[0] or 0
    new = files.withColumnRenamed("path", "file_path").join(index.select("file_path"), "file_path", "left_anti")
    return numbered(new, "file_path", "seq_id", last).select("seq_id", "file_path", "file_hash", F.col("length").alias("file_size"), F.lit(at).alias("indexed_at"))


def processed_files(log: DataFrame) -> DataFrame:
    """The state that the events of each file lead to: status, hash and run of the last; how often it failed;
    chunks of the last completion; the error of the last end, none if that was a completion."""
    done, failed = F.col("event") == "completed", F.col("event") == "failed"
    order = F.col("seq")
    return log.groupBy("file_path").agg(
        F.max_by("file_hash", order).alias("file_hash"),
        F.max_by("event", order).alias("status"),
        F.coalesce(F.max_by("chunks", F.when(done, order)), F.lit(0)).cast("int").alias("chunks_count"),
        F.max_by(F.when(failed, F.col("error")), F.when(done | failed, order)).alias("error_msg"),
        F.count_if(failed).cast("int").alias("retry_count"),
        F.max_by("run_id", order).alias("run_id"),
        F.max_by("ts", order).alias("updated_at"),
    )


def unprocessed(index: DataFrame, processed: DataFrame, retries: int | None = None) -> DataFrame:
    """Indexed files that are not completed, by seq_id; without dead letters if `retries` is given."""
    done = F.col("status") == "completed"
    if retries is not None:
        done = done | ((F.col("status") == "failed") & (F.col("retry_count") >= retries))
    return index.join(processed.where(done), "file_path", "left_anti").orderBy("seq_id")


def unprocessed_or_changed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files (file_path, file_hash) that are new, not completed, or completed with another hash."""
    same = processed.where(F.col("status") == "completed").select("file_path", "file_hash")
    return files.join(same, ["file_path", "file_hash"], "left_anti")


def stale_reset(processed: DataFrame) -> DataFrame:
    return processed.withColumn("status", F.when(F.col("status") == "processing", "pending").otherwise(F.col("status")))


def retryable(processed: DataFrame, retries: int = 3) -> DataFrame:
    return processed.where((F.col("status") == "failed") & (F.col("retry_count") < retries))


def dead_letters(processed: DataFrame, retries: int = 3) -> DataFrame:
    return processed.where((F.col("status") == "failed") & (F.col("retry_count") >= retries))


def stats(processed: DataFrame) -> DataFrame:
    """One row: files by status, and chunks of the completed."""
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    chunks = F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("chunks_count"))), F.lit(0)).cast("long")
    return processed.agg(of("completed"), of("failed"), of("processing"), of("pending"), chunks.alias("total_chunks"))


def run_summary(log: DataFrame) -> DataFrame:
    """For each run: its files, how many it completed and failed last, when it began and ended."""
    last = log.groupBy("run_id", "file_path").agg(F.max_by("event", "seq").alias("event"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    of = lambda s: F.count_if(F.col("event") == s)
    return last.groupBy("run_id").agg(F.count("*").alias("total_files"), of("completed").alias("completed_files"), of("failed").alias("failed_files"), F.min("first").alias("started_at"), F.max("last").alias("finished_at"))


def latest(pairs: DataFrame) -> DataFrame:
    """The last value of each key of (key, value, updated_at)."""
    return pairs.groupBy("key").agg(F.max_by("value", F.struct("updated_at", "value")).alias("value"), F.max("updated_at").alias("updated_at"))


class StateStore:
    """The log, the index, runs and checkpoints as Parquet below one folder; every change is an append."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        empty = self.spark.createDataFrame([], schema)
        path = f"{self.root}/{name}"
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_path):
            empty.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def log(self) -> DataFrame:
        return self._table("log", LOG)

    def index(self) -> DataFrame:
        return self._table("index", INDEX)

    def runs(self) -> DataFrame:
        """Runs by start, the last first; a run's two records become one."""
        found = self._table("runs", RUNS).groupBy("run_id").agg(F.max("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"), F.max("total_files").alias("total_files"))
        return found.orderBy(F.desc("started_at"), "run_id")

    def append(self, name: str, schema: str, rows: DataFrame | list[tuple]) -> None:
        self._table(name, schema)
        rows = self.spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
        names = [f.name for f in self.spark.createDataFrame([], schema).schema]
        rows.select(*names).write.mode("append").parquet(f"{self.root}/{name}")

    def add_to_index(self, files: DataFrame, at: float) -> int:
        new = index_additions(files, self.index(), at).persist()
        n = new.count()
        if n:
            self.append("index", INDEX, new)
        new.unpersist()
        return n

    def start_run(self, total: int, at: float) -> str:
        run_id = f"run-{uuid.uuid4().hex[:12]}"
        self.append("runs", RUNS, [(run_id, at, None, total)])
        return run_id

    def finish_run(self, run_id: str, at: float) -> None:
        self.append("runs", RUNS, [(run_id, None, at, None)])

    def reset_stale(self, at: float) -> int:
        """Files left in processing become pending; how many."""
        stale = processed_files(self.log()).where(F.col("status") == "processing")
        last = self.log().agg(F.max("seq")).first()[0] or 0
        n = stale.count()
        if n:
            rows = stale.select(F.lit(last + 1).alias("seq"), "file_path", "file_hash", F.lit("pending").alias("event"), F.lit(None).cast("int").alias("chunks"), F.lit(None).cast("string").alias("error"), "run_id", F.lit(at).alias("ts"))
            self.append("log", LOG, rows)
        return n

    def put(self, key: str, value: str, at: float) -> None:
        self.append("checkpoints", CHECKPOINTS, [(key, value, at)])

    def get(self, key: str) -> str | None:
        found = latest(self._table("checkpoints", CHECKPOINTS).where(F.col("key") == key)).first()
        return found["value"] if found else None
