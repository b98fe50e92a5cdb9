"""Ingestion as a stream of files: what has been seen is the stream's checkpoint, and batches may be redone."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import rules, text
from ..operators.chunking import chunk_id, counted, split_characters, split_text
from ..operators.ingest import with_outcome
from ..operators.tables import give_back, small_batches
from ..sources.characters import BLOCK_BYTES, Characters
from ..sources.files import CONVERTERS, plain_text
from ..sources.place import opened_for

#: Characters in a batch of chunks that a task hands on, about, and texts shorter than which fail.
_BATCH, _LEAST = 4 << 20, 10


def file_stream(spark: SparkSession, root: str, files_a_batch: int = 1000, extensions: list[str] = rules.TARGET_EXTENSIONS, content: bool = False) -> DataFrame:
    """path, modificationTime, length and ext of the files that arrive below `root`. Content, each file whole in one row, comes only
    if asked for: it is for stores that Spark can read and Arrow cannot open."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_a_batch).load(root)
    columns = ["path", "modificationTime", "length", *(["content"] if content else [])]
    return files.withColumn("ext", text.suffix("path")).where(F.col("ext").isin(extensions)).select(*columns, "ext")


def _text(path: str, ext: str, data: bytes | None) -> tuple[str | Characters | None, str | None]:
    """A file's text, or why it has none; a large text file is not held. A file that is gone ends the job."""
    if ext not in CONVERTERS:
        return None, "unsupported"
    if data is None:
        fs, place = opened_for(path)
        with fs.open_input_file(place) as f:
            if CONVERTERS[ext] is plain_text and f.size() > BLOCK_BYTES:
                return Characters(lambda: fs.open_input_file(place)), None
            data = f.read()
    try:
        return CONVERTERS[ext](data), None
    except Exception as e:  # a damaged file must not end the job; its cause is kept
        return None, f"conversion: {type(e).__name__}: {e}"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | Characters | None, int | None, str | None]]:
    """Of each file its path, text, number of characters without the white space around them, and error."""
    for batch in batches:
        for k, (path, ext) in enumerate(zip(batch["path"].to_pylist(), batch["ext"].to_pylist(), strict=True)):
            found, error = _text(path, ext, batch["content"][k].as_py() if "content" in batch.schema.names else None)
            yield path, found, found.stripped_length if isinstance(found, Characters) else None if found is None else len(found.strip(text.SPACES)), error


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        kinds = {"source_path": pa.string(), "text": pa.string(), "chunk_index": pa.int32(), "total_chunks": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    for path, found, characters, _ in _texts(batches):
        if (characters or 0) < _LEAST:
            continue
        total, chunks = counted(partial(split_characters, found) if isinstance(found, Characters) else split_text(found).__iter__)
        for k, chunk in enumerate(chunks):
            rows.append((path, chunk, k, total))
            size += len(chunk)
            if size >= _BATCH:
                yield batch()
                rows, size = [], 0
    if rows:
        yield batch()
    give_back()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path, _, characters, error in _texts(batches):
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([characters], pa.int64()), pa.array([error], pa.string())], ["path", "characters", "error"])
    give_back()


def ingest(files: DataFrame, chunks_path: str, status_path: str, checkpoint: str, embed: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Converts, validates, chunks (and embeds) each batch of a file stream until all files that are there have
    been taken. Chunks come before the status, each below a folder of the batch's number, which is replaced
    if the batch is redone, so a lost driver leaves no row twice.

    Tasks open the files, and what they hold of a text file does not grow with it: its chunks leave as they are cut. What has chunks
    is a success; only files without any are looked at again, for the reason. `embed` keeps source_path."""

    def batch(rows: DataFrame, number: int) -> None:
        names = ["path", "ext", *(["content"] if "content" in rows.columns else [])]
        small_batches(rows.sparkSession)
        rows = rows.select(*names)
        cut = rows.mapInArrow(_chunks, "source_path string, text string, chunk_index int, total_chunks int")
        chunks = cut.select(chunk_id("source_path").alias("chunk_id"), "text", "chunk_index", "total_chunks", "source_path")
        folder = f"{chunks_path}/batch={number}"
        (embed(chunks) if embed else chunks).write.mode("overwrite").parquet(folder)
        cut_paths = rows.sparkSession.read.schema("source_path string").parquet(folder).select(F.col("source_path").alias("path")).distinct()
        rest = rows.join(F.broadcast(cut_paths), "path", "left_anti").mapInArrow(_ends, "path string, characters long, error string")
        rest = with_outcome(rest, _LEAST, ~F.coalesce(F.col("error") == "unsupported", F.lit(False)), F.col("characters"))
        done = cut_paths.select("path", F.lit("success").alias("status"), F.lit(None).cast("string").alias("reason"))
        done.unionByName(rest.select("path", "status", F.coalesce("error", "reason").alias("reason"))).write.mode("overwrite").parquet(f"{status_path}/batch={number}")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ProgressLog(StreamingQueryListener):
    """Writes a line for each batch: its number, rows, and rows a second."""

    def __init__(self, log: logging.Logger | None = None):
        self.log = log or logging.getLogger(__name__)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.log.info("started %s", event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.log.info("batch %s: %s rows, %.1f a second", p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.log.info("ended %s: %s", event.id, event.exception or "done")
