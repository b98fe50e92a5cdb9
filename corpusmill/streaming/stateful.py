"""Streams with keyed state: the status of each file, batches for an embedder, and chunks that arrive once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, on disk and not in the heap; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


#: What is known of a file: its last event, its last completion, its last end, and how often it failed. Each part has the
#: number of its event, so two such rows merge in any order.
_PARTS = ((0, 5), (5, 7), (7, 9))


def _merged(a: tuple, b: tuple) -> tuple:
    """What the aggregate of `status_updates` makes of two states; it hangs on no order."""
    out: list = []
    for start, end in _PARTS:
        later = b if b[start] is not None and (a[start] is None or b[start] > a[start]) else a
        out += later[start:end]
    return (*out, a[9] + b[9])


def status_updates(log: DataFrame) -> DataFrame:
    """The status of each file that a trigger has events of, as a stream: `log` (as operators.state.LOG) may come in any
    order and cut. It is an aggregate with state, which merges events by task before the shuffle, so a file with many of them is few rows and no
    row goes through Python. A null path is a file; of events with one number the greatest counts, and each counts as a failure."""
    done, failed = F.col("event") == "completed", F.col("event") == "failed"
    last = F.struct(F.col("seq").alias("last"), "file_hash", F.col("event").alias("status"), "run_id", F.col("ts").alias("updated_at"))
    folds = log.groupBy("file_path").agg(
        F.max(last).alias("a"), F.max(F.when(done, F.struct(F.col("seq").alias("done"), "chunks"))).alias("b"),
        F.max(F.when(done | failed, F.struct(F.col("seq").alias("ended"), F.when(failed, F.col("error")).alias("error")))).alias("c"), F.count_if(failed).cast("int").alias("failures"),
    )
    return folds.select("file_path", "a.*", "b.*", "c.*", "failures")


def keep_status(log: DataFrame, status_path: str, checkpoint: str) -> StreamingQuery:
    """Folds what a log stream has until now into `status_path`. A later call with the same checkpoint goes on from the
    state that the last one left; a trigger that is redone replaces its own folder."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{status_path}/trigger={number}")

    with rocksdb(log.sparkSession):
        return status_updates(log).writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status(spark: SparkSession, status_path: str) -> DataFrame:
    """The rows of operators.state.processed_files, out of what `keep_status` has written."""
    every = spark.read.parquet(status_path)
    fold = [c for c in every.columns if c not in ("file_path", "batch", "trigger")]
    last = every.groupBy("file_path").agg(F.max_by(F.struct(*fold), "batch").alias("x")).select("file_path", "x.*")
    return last.select("file_path", "file_hash", "status", F.coalesce("chunks", F.lit(0)).alias("chunks_count"), F.col("error").alias("error_msg"), F.col("failures").alias("retry_count"), "run_id", "updated_at")


class _Batches(StatefulProcessor):
    """State: the number of the open batch, its tokens, and its items in order."""

    def __init__(self, max_tokens: int, max_items: int, idle_ms: int | None):
        self.max_tokens, self.max_items, self.idle_ms = max_tokens, max_items, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "number long, tokens long, items array<string>")

    def _sent(self, key, number: int, tokens: int, items: list[str], why: str) -> Row:
        return Row(lane=key[0], batch=number, items=items, tokens=tokens, why=why)

    def _watch(self, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        number, tokens, items = tuple(self.open.get()) if self.open.exists() else (0, 0, [])
        items = list(items)
        for row in sorted(rows, key=lambda r: r.at):
            if items and (tokens + row.tokens > self.max_tokens or len(items) >= self.max_items):
                yield self._sent(key, number, tokens, items, "full")
                number, tokens, items = number + 1, 0, []
            tokens, items = tokens + row.tokens, [*items, row.item]
        self.open.update((number, tokens, items))
        if self.idle_ms is not None:
            self._watch(timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        number, tokens, items = tuple(self.open.get()) if self.open.exists() else (0, 0, [])
        if items:
            self.open.update((number + 1, 0, []))
            yield self._sent(key, number, tokens, list(items), "idle")

    def close(self) -> None:
        pass


_SENT = "lane string, batch long, items array<string>, tokens long, why string"


def embedding_batches(items: DataFrame, max_tokens: int = 8000, max_items: int = 2048, idle_ms: int | None = 2000) -> DataFrame:
    """Batches of the stream `items` (lane, at, item, tokens), which leave as soon as the next item would bring them over a
    limit (`why`: full), or when their lane has had nothing for `idle_ms` (idle). Lanes are what is sent side by side; an
    item's place in its lane, `at`, orders the items of a trigger. Without `idle_ms` a batch waits until it is full, and
    `left_open` has what waits."""
    lanes = items.select("lane", F.col("at").cast("long").alias("at"), F.col("item").cast("string").alias("item"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    mode = "None" if idle_ms is None else "ProcessingTime"
    return lanes.groupBy("lane").transformWithState(_Batches(max_tokens, max_items, idle_ms), _SENT, "Update", mode)


def send_batches(batches: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes batches below `path`, a folder a trigger."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/trigger={number}")

    with rocksdb(batches.sparkSession):
        return batches.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def left_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The batches that wait in the state of a query that has ended, in the form of `embedding_batches`."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    return held.select(F.col("key.lane").alias("lane"), F.col("value.number").alias("batch"), F.col("value.items").alias("items"), F.col("value.tokens").alias("tokens"), F.lit("open").alias("why")).where(F.size("items") > 0)


def new_chunks(chunks: DataFrame, delay: str = "1 hour", time: str = "at", key: str = "chunk_id") -> DataFrame:
    """The stream `chunks` with each `key` once: a file that comes again adds nothing. What is known of a key is given up when the watermark
    on `time` has passed its first row by `delay`, so the state stays as large as what arrives within it."""
    return chunks.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
