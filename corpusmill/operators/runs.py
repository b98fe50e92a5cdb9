"""A whole ingestion run over a folder of files, with state that a later run resumes from."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import rules, text
from ..sources import files as sources
from ..sources import reader
from . import chunking, ingest, state
from .tables import deleted

#: Bytes of files that are taken in between two entries in the log, about.
COMMIT_BYTES = 64 << 30


def _logged(store: state.StateStore, rows: DataFrame, event: Column, chunks: Column, error: Column, run_id: str) -> None:
    """Appends an event for each of `rows` (file_path, file_hash)."""
    last = store.log().agg(F.max("seq")).first()[0] or 0
    events = state.numbered(rows, "file_path", "seq", last)
    store.append("log", state.LOG, events.select("seq", "file_path", "file_hash", event.alias("event"), chunks.cast("int").alias("chunks"), error.cast("string").alias("error"), F.lit(run_id).alias("run_id"), F.lit(time.time()).alias("ts")))


def run(spark: SparkSession, root: str, store: state.StateStore, vectors: str, embed: Callable[[DataFrame], DataFrame] | None = None, resume: bool = True, max_files: int | None = None, extensions: list[str] = rules.TARGET_EXTENSIONS, settings: Settings = Settings(), converters: dict[str, sources.Converter] | None = None, part_bytes: int = reader.PART_BYTES, commit_bytes: int = COMMIT_BYTES) -> DataFrame:  # noqa: B008
    """Ingests the files below `root` that are new, changed or not completed (all of them without `resume`), at
    most `max_files`, and returns the run's outcomes: file_path, status, reason, chunks. No other file is opened.

    Files are taken in by about `commit_bytes` at a time: the log has them as processing, then their chunks (with vectors, if
    `embed` adds them) go to a folder of the run below `vectors`, then the log says how they ended. A run that dies
    loses what it has not logged; the next one finds these files as pending and takes only them and what comes after.
    `current` reads what is in force."""
    now = time.time()
    store.reset_stale(now)
    found = sources.scan(spark, root, extensions).withColumn("file_hash", text.stat_hash("path", "length", F.unix_micros("modificationTime")))
    store.add_to_index(found.select("path", "length", "file_hash"), now)
    keys = found.select(F.col("path").alias("file_path"), "ext", "length", F.unix_micros("modificationTime").alias("modificationTime"), "file_hash")
    todo = state.unprocessed_or_changed(keys, state.processed_files(store.log())) if resume else keys
    if max_files:
        todo = todo.orderBy("file_path").limit(max_files)
    todo = todo.select(F.col("file_path").alias("path"), "ext", "length", "modificationTime", "file_hash")
    files = reader.listed(todo, part_bytes)
    run_id = store.start_run(todo.count(), now)
    work, step = f"{store.root}/work/{run_id}", max(1, commit_bytes // part_bytes)
    for first in range(0, files.parts, step):
        _commit(spark, store, files, first, min(first + step, files.parts), run_id, work, f"{vectors}/run={run_id}", text_root(root), embed, settings, converters, now)
    deleted(spark, files.folder)
    store.finish_run(run_id, time.time())
    schema = "file_path string, status string, reason string, chunks int"
    return spark.read.schema(schema).parquet(f"{work}/outcomes") if files.parts else spark.createDataFrame([], schema)


def _commit(spark: SparkSession, store: state.StateStore, files: reader.FileList, first: int, end: int, run_id: str, work: str, vectors: str, root: str, embed: Callable[[DataFrame], DataFrame] | None, settings: Settings, converters: dict[str, sources.Converter] | None, now: float) -> None:
    none = F.lit(None)
    begun = spark.read.parquet(files.folder).where((F.col("part") >= first) & (F.col("part") < end))
    _logged(store, begun.select(F.col("path").alias("file_path"), "file_hash"), F.lit("processing"), none, none, run_id)
    docs = reader.read(spark, files, converters, first, end).withColumnRenamed("path", "file_path")
    docs = ingest.with_outcome(docs, settings.least_characters, ~F.coalesce(F.col("error") == "unsupported", F.lit(False)))
    docs.withColumn("reason", F.coalesce("error", "reason")).write.mode("overwrite").parquet(f"{work}/docs/{first}")
    docs = spark.read.parquet(f"{work}/docs/{first}")
    meta = ingest.with_metadata(docs.where("status = 'success'").withColumnRenamed("file_path", "path"), root)
    names = ["source_path", "file_name", "file_type", "file_size", "project", "sub_path", "year", "category"]
    chunks = chunking.chunked(meta.select("text", *names), settings.chunk_size, settings.chunk_overlap)
    (embed(chunks) if embed else chunks).withColumn("at", F.lit(now)).write.mode("overwrite").parquet(f"{vectors}/commit={first}")
    counts = spark.read.parquet(f"{vectors}/commit={first}").groupBy(F.col("source_path").alias("file_path")).agg(F.count("*").cast("int").alias("chunks"))
    done = docs.join(counts, "file_path", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
    success = F.col("status") == "success"
    _logged(store, done, F.when(success, "completed").otherwise("failed"), F.when(success, F.col("chunks")), F.when(~success, F.col("reason")), run_id)
    done.select("file_path", "status", "reason", "chunks").write.mode("append").parquet(f"{work}/outcomes")


def text_root(root: str) -> str:
    """A folder as the paths of its files begin."""
    return root if "://" in root or root.startswith("file:") else f"file:{root}"


def current(spark: SparkSession, vectors: str) -> DataFrame:
    """The chunks in force: of each source those of the last run that took it."""
    every = spark.read.parquet(vectors)
    last = every.groupBy("source_path").agg(F.max("at").alias("at"))
    return every.join(last, ["source_path", "at"], "left_semi")
