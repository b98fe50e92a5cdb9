import random
import time

from pyspark.sql import functions as F

from corpusmill.operators import chunking, state
from corpusmill.streaming import stateful

EVENTS = ["processing", "completed", "failed", "pending"]


def log_of(spark, n, paths):
    rng = random.Random(7)
    rows = [(i, rng.choice(paths), f"h{i % 5}" if i % 4 else None, rng.choice(EVENTS), i if i % 3 else None, f"e{i}" if i % 2 else None, f"run{i // 50}", float(i)) for i in range(n)]
    return spark.createDataFrame(rows, state.LOG)


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def test_status_over_restarts_in_any_order(spark, tmp_path):
    log = log_of(spark, 400, ["a", "b", "c", None, "hot", "hot", "hot"])
    for part in random.Random(1).sample(range(4), 4):
        log.where(F.col("seq") % 4 == part).repartition(2).write.mode("append").parquet(f"{tmp_path}/log")
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
        stateful.keep_status(stream, f"{tmp_path}/status", f"{tmp_path}/cp").awaitTermination()
    assert rows_of(stateful.status(spark, f"{tmp_path}/status")) == rows_of(state.processed_files(log))


def test_merge_hangs_on_no_order():
    a, b = (5, "h5", "failed", "r", 1.0, None, None, 5, "x", 1), (9, None, "completed", "q", 2.0, 9, 3, 9, None, 0)
    assert stateful._merged(a, b) == stateful._merged(b, a) == (9, None, "completed", "q", 2.0, 9, 3, 9, None, 1)


def items_of(spark, n):
    tokens = F.when(F.col("id") == 17, 500).otherwise(F.col("id") * 37 % 60)
    return spark.range(n).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("lane"), F.col("id").alias("at"), F.col("id").cast("string").alias("item"), tokens.alias("tokens"))


def write_in_order(items, path, parts=3):
    n = items.count()
    for k in range(parts):
        items.where((F.col("at") >= k * n // parts) & (F.col("at") < (k + 1) * n // parts)).coalesce(1).write.mode("append").parquet(path)


def test_stream_batches_are_those_of_the_table(spark, tmp_path):
    items = items_of(spark, 150)
    write_in_order(items, f"{tmp_path}/items")
    stream = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/items")
    stateful.send_batches(stateful.embedding_batches(stream, 200, 7, None), f"{tmp_path}/sent", f"{tmp_path}/cp").awaitTermination()
    sent = spark.read.parquet(f"{tmp_path}/sent").drop("trigger").unionByName(stateful.left_open(spark, f"{tmp_path}/cp"))
    got = {(r.lane, r.batch): r["items"] for r in sent.collect()}
    want: dict = {}
    for r in chunking.token_batches(items, ["lane"], ["at"], "tokens", 200, 7).orderBy("at").collect():
        want.setdefault((r.lane, r.batch), []).append(r.item)
    assert got == want and max(map(len, got.values())) == 7


def test_half_full_batch_leaves_after_a_while(spark, tmp_path):
    items = items_of(spark, 5)
    write_in_order(items, f"{tmp_path}/items", 1)
    stream = spark.readStream.schema(items.schema).parquet(f"{tmp_path}/items")
    query = stateful.send_batches(stateful.embedding_batches(stream, 10_000, 100, idle_ms=2000), f"{tmp_path}/sent", f"{tmp_path}/cp", processingTime="500 milliseconds")
    sent, until = [], time.time() + 60
    while time.time() < until and len(sent) < 2:
        time.sleep(1)
        if (tmp_path / "sent").exists():
            sent = [r for r in spark.read.schema(stateful._SENT).option("recursiveFileLookup", True).parquet(f"{tmp_path}/sent").collect()]
    query.stop()
    assert sorted((r.lane, r.batch, r["items"], r.why) for r in sent) == [("cold", 0, ["0"], "idle"), ("hot", 0, ["1", "2", "3", "4"], "idle")]


def test_replayed_chunks_add_nothing_and_state_is_given_up(spark, tmp_path):
    schema = "chunk_id string, at timestamp"
    at = lambda h: F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") + 3600 * h)
    rows = lambda first, h: spark.range(first, first + 50).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("chunk_id"), at(h).alias("at"))
    states = []
    for first, hour in ((0, 0), (0, 0), (100, 10), (200, 20)):
        rows(first, hour).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stateful.new_chunks(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "1 hour")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        states += [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    got = [r.chunk_id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == len(set(got)) == 150
    assert max(states) <= 100 and states[-1] == 50  # the first ones were forgotten


def test_the_session_keeps_its_provider(spark):
    before = spark.conf.get(stateful._PROVIDER, None)
    with stateful.rocksdb(spark):
        assert spark.conf.get(stateful._PROVIDER).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(stateful._PROVIDER, None) == before


def test_batches_arrive_in_bounded_files(spark, sf_dir, monkeypatch):
    """A file of the stream holds a bounded number of rows, and no task that writes one reads the documents."""
    from corpusmill.plans import stream_queries

    want = rows_of(stream_queries.stream_batches(spark, sf_dir))
    sizes, real = [], stateful.send_batches

    def noted(batches, path, checkpoint, **trigger):
        out = real(batches, path, checkpoint, **trigger)
        found = spark.read.parquet(path.replace("/sent", "/items"))
        sizes.extend(r["count"] for r in found.groupBy(F.input_file_name()).count().collect())
        return out

    monkeypatch.setattr(stream_queries, "_FILE_ROWS", 17)
    monkeypatch.setattr(stateful, "send_batches", noted)
    assert rows_of(stream_queries.stream_batches(spark, sf_dir)) == want
    assert max(sizes) <= 17 and len(sizes) > 4


def test_status_passes_no_row_through_python(spark, tmp_path):
    log_of(spark, 40, ["a", "b"]).write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(state.LOG).parquet(f"{tmp_path}/log")
    plan = stateful.status_updates(stream)._jdf.queryExecution().logical().toString()
    assert "Python" not in plan and "InArrow" not in plan and "TransformWithState" not in plan
