"""Queries over streams with state: Spark writes tables as files, streams take them in, some after a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.tables import deleted, dropped, new_folder, placed, written
from ..streaming import stateful
from .registry import LOG, log, query, table


#: Rows (of a few numbers) in a file of a stream of batches, which a task writes and a trigger takes in.
_FILE_ROWS = 250_000


def _kept(top: str, rows: DataFrame) -> DataFrame:
    """`rows` as a table of their own; the folder that they were made in goes."""
    out = written(rows)
    deleted(rows.sparkSession, top)
    return out


@query(f"WITH {LOG} SELECT file_path, file_hash, status, chunks_count, error_msg, retry_count, run_id, updated_at FROM state")
def status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in two halves, each in files that cut across its order; after the first the query ends and starts anew from its
    checkpoint."""
    top, events = new_folder(spark, "stream"), log(spark, sf_dir)
    for half in (1, 0):
        events.where(F.col("seq") % 2 == half).repartition(4, F.col("seq") % 4).write.mode("append").parquet(f"{top}/log")
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{top}/log")
        stateful.keep_status(arriving, f"{top}/status", f"{top}/checkpoint").awaitTermination()
    return _kept(top, stateful.status(spark, f"{top}/status"))


@query("""WITH RECURSIVE items AS (
  SELECT source, doc_id, ceil(strlen(coalesce(text, '')) / 4.0)::BIGINT AS tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents
), fold AS (
  SELECT source, doc_id, tokens, k, 0::BIGINT AS batch, tokens AS s, 1::BIGINT AS n FROM items WHERE k = 1
  UNION ALL
  SELECT i.source, i.doc_id, i.tokens, i.k, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN f.batch + 1 ELSE f.batch END,
    CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN i.tokens ELSE f.s + i.tokens END, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN 1 ELSE f.n + 1 END
  FROM fold f JOIN items i ON i.source = f.source AND i.k = f.k + 1
) SELECT source AS lane, batch, count(*) AS items, sum(tokens)::BIGINT AS tokens, min(doc_id)::VARCHAR AS first_item FROM fold GROUP BY ALL""")
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a lane; the documents arrive in order of doc_id, in four files or as many as hold a bounded number of rows. What is
    still open at the end is read out of the state."""
    top = new_folder(spark, "stream")
    items = table(spark, sf_dir, "documents").select(F.col("source").alias("lane"), F.col("doc_id").alias("at"), F.col("doc_id").cast("string").alias("item"), text.estimated_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    laid = placed(items, [], ["at"])
    n = laid.count()
    rows = max(1, min(_FILE_ROWS, -(-n // 4)))
    laid.select(*items.columns, F.floor(F.col("_i") / rows).alias("part")).repartition("part").write.partitionBy("part").parquet(f"{top}/laid")
    dropped(laid)
    for k in range(-(-n // rows)):
        spark.read.schema(items.schema).parquet(f"{top}/laid/part={k}").coalesce(1).write.mode("append").parquet(f"{top}/items")
    if not n:
        items.write.parquet(f"{top}/items")
    arriving = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/items")
    stateful.send_batches(stateful.embedding_batches(arriving, 8000, 16, idle_ms=None), f"{top}/sent", f"{top}/checkpoint").awaitTermination()
    every = spark.read.parquet(f"{top}/sent").drop("trigger").unionByName(stateful.left_open(spark, f"{top}/checkpoint"))
    return _kept(top, every.select("lane", "batch", F.size("items").cast("long").alias("items"), "tokens", F.col("items")[0].alias("first_item")))


@query("""SELECT DISTINCT ON (chunk_id) md5(coalesce(text, '')) AS chunk_id, length(coalesce(text, ''))::INT AS chars FROM documents ORDER BY chunk_id""")
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by content, which come in two files and then, after a restart, once more: copies and what is replayed add nothing."""
    top = new_folder(spark, "stream")
    chunks = table(spark, sf_dir, "documents").select(F.md5(F.coalesce("text", F.lit(""))).alias("chunk_id"), F.length(F.coalesce("text", F.lit(""))).alias("chars"), F.timestamp_micros(F.lit(1_600_000_000_000_000) + F.col("doc_id") * 1000).alias("at"))
    for _ in range(2):
        chunks.repartition(2, "chunk_id").write.mode("append").parquet(f"{top}/chunks")
        arriving = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(f"{top}/chunks")
        once = stateful.new_chunks(arriving, "30 days").select("chunk_id", "chars")
        once.writeStream.format("parquet").option("checkpointLocation", f"{top}/checkpoint").trigger(availableNow=True).start(f"{top}/once").awaitTermination()
    return _kept(top, spark.read.parquet(f"{top}/once"))
