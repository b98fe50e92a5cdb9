"""Queries over files, outcomes and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import ingest, state
from ..operators.tables import deleted, dropped, new_folder, written
from ..sources import files as sources
from ..sources import reader
from .registry import FILES, LOG, ROOT, SPACE, files, log, query, strip_sql, table

_TARGET = ", ".join(f"'{e}'" for e in rules.TARGET_EXTENSIONS)
_CATEGORY = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(low, {w.lower()!r})' for w in words)} THEN '{label}'" for label, words in rules.CATEGORIES) + f" ELSE '{rules.OTHER_CATEGORY}' END"
_META = f"""WITH {FILES}, parts AS (
  SELECT *, split(substr(path, {len(ROOT) + 2}), '/') AS p FROM named
), meta AS (
  SELECT *, lower(array_to_string(p, ' ')) AS low,
    coalesce(list_filter(list_transform(p, lambda x: regexp_extract(x, '(19\\d{{2}}|20\\d{{2}})', 1)), lambda y: y >= '1990' AND y <= '2030')[1], year(make_timestamp(mtime))::VARCHAR) AS year
  FROM parts
)"""


@query(f"WITH {FILES} SELECT path, ext, length FROM named WHERE ext IN ({_TARGET})")
def scan_extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_extension(files(spark, sf_dir)).select("path", "ext", "length")


@query(f"WITH {FILES} SELECT path, md5(path || ':' || length::VARCHAR || ':' || mtime::VARCHAR) AS file_hash FROM named")
def stat_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir).select("path", text.stat_hash("path", "length", "modificationTime").alias("file_hash"))


@query(f"""{_META} SELECT path AS source_path, name AS file_name, ext AS file_type, length AS file_size,
  regexp_replace(regexp_replace({strip_sql('p[1]')}, '^[_-]+|[_-]+$', '', 'g'), '{SPACE}+', ' ', 'g') AS project,
  array_to_string(p[2:len(p) - 1], '/') AS sub_path, year, {_CATEGORY} AS category FROM meta""")
def normalize_path_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["source_path", "file_name", "file_type", "file_size", "project", "sub_path", "year", "category"]
    return ingest.with_metadata(files(spark, sf_dir), ROOT).select(*names)


@query(f"{_META} SELECT year, count(*) AS n FROM meta GROUP BY year")
def extract_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_metadata(files(spark, sf_dir), ROOT).groupBy("year").agg(F.count("*").alias("n"))


@query(f"{_META} SELECT {_CATEGORY} AS category, count(*) AS n FROM meta GROUP BY 1")
def classify_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_metadata(files(spark, sf_dir), ROOT).groupBy("category").agg(F.count("*").alias("n"))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = files(spark, sf_dir).select("doc_id", text.suffix("path").alias("ext"), "path").join(texts, "doc_id")
    return ingest.with_outcome(docs, supported=F.col("ext").isin(rules.TARGET_EXTENSIONS))


_OUTCOMES = f"""WITH {FILES}, outcomes AS (
  SELECT n.doc_id, ext, CASE WHEN ext NOT IN ({_TARGET}) THEN 'skipped' WHEN coalesce(length({strip_sql('text')}) < 10, true) THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN ext NOT IN ({_TARGET}) THEN 'unsupported' WHEN coalesce(length({strip_sql('text')}) < 10, true) THEN 'empty or too short' END AS reason, coalesce(length(text), 0) AS chars
  FROM named n JOIN documents d USING (doc_id)
)"""


@query(f"{_OUTCOMES} SELECT doc_id, ext, status, reason FROM outcomes")
def validity_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select("doc_id", "ext", "status", "reason")


@query(f"""{_OUTCOMES}, s AS (SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'skipped') AS skipped, coalesce(sum(CASE WHEN status = 'success' THEN chars // 1000 + 1 END), 0)::BIGINT AS chunks FROM outcomes)
SELECT *, printf('%.1f', round(100.0::DOUBLE * success / greatest(total, 1), 1)) || '%' AS success_rate FROM s""")
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = F.when(F.col("status") == "success", F.floor(F.length("text") / 1000) + 1)
    return ingest.ingest_stats(_outcomes(spark, sf_dir).withColumn("chunks", chunks))


@query(f"{_OUTCOMES} SELECT ext, status, count(*) AS n FROM outcomes GROUP BY GROUPING SETS ((status), (ext, status))")
def outcome_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.outcomes_by_extension(_outcomes(spark, sf_dir))


@query(f"""WITH {FILES}, pairs AS (SELECT ext, path, row_number() OVER (PARTITION BY ext ORDER BY path) AS k, (SELECT count(DISTINCT ext) FROM named) AS kinds FROM named)
SELECT ext, path FROM pairs WHERE k <= greatest(1, 60 // kinds) ORDER BY path LIMIT 60""")
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.even_sample(files(spark, sf_dir).withColumn("ext", text.suffix("path")), 60).select("ext", "path")


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All files, and those already indexed: the labelled documents."""
    every = files(spark, sf_dir).withColumn("file_hash", text.stat_hash("path", "length", "modificationTime"))
    known = every.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return every, known.select((F.col("doc_id") + 1).alias("seq_id"), F.col("path").alias("file_path"), "file_hash", F.col("length").alias("file_size"), F.lit(0.0).alias("indexed_at"))


@query(f"""WITH {FILES}, new AS (SELECT path, length, mtime FROM named WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT (SELECT max(doc_id) + 1 FROM labels) + row_number() OVER (ORDER BY md5(path), path) AS seq_id, path AS file_path, md5(path || ':' || length::VARCHAR || ':' || mtime::VARCHAR) AS file_hash, length AS file_size FROM new""")
def index_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, index = _index(spark, sf_dir)
    return state.index_additions(every, index, 1.0).drop("indexed_at")


_DONE = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'completed' ELSE 'processing' END AS status, (doc_id % 5)::INT AS retry_count, doc_id % 7 = 0 AS changed FROM labels"


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, _ = _index(spark, sf_dir)
    status = F.when(F.col("toxic") == 1, "failed").when(F.col("quality") == 1, "completed").otherwise("processing")
    rows = table(spark, sf_dir, "labels").join(every, "doc_id")
    return rows.select(F.col("path").alias("file_path"), F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("file_hash")).alias("file_hash"), status.alias("status"), (F.col("doc_id") % 5).cast("int").alias("retry_count"))


@query(f"WITH {FILES}, done AS ({_DONE}) SELECT doc_id + 1 AS seq_id, path AS file_path FROM named WHERE doc_id NOT IN (SELECT doc_id FROM done WHERE status = 'completed')")
def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = files(spark, sf_dir).select((F.col("doc_id") + 1).alias("seq_id"), F.col("path").alias("file_path"))
    return state.unprocessed(every, _processed(spark, sf_dir))


@query(f"WITH {FILES}, done AS ({_DONE}) SELECT path AS file_path FROM named WHERE doc_id NOT IN (SELECT doc_id FROM done WHERE status = 'completed' OR status = 'failed' AND retry_count >= 3)")
def unprocessed_without_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = files(spark, sf_dir).select((F.col("doc_id") + 1).alias("seq_id"), F.col("path").alias("file_path"))
    return state.unprocessed(every, _processed(spark, sf_dir), retries=3).select("file_path")


@query(f"WITH {FILES}, done AS ({_DONE}) SELECT path AS file_path FROM named WHERE doc_id NOT IN (SELECT doc_id FROM done WHERE status = 'completed' AND NOT changed)")
def unprocessed_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, _ = _index(spark, sf_dir)
    return state.unprocessed_or_changed(every.select(F.col("path").alias("file_path"), "file_hash"), _processed(spark, sf_dir)).select("file_path")


@query(f"WITH {LOG} SELECT file_path, file_hash, status, chunks_count, error_msg, retry_count, run_id, updated_at FROM state")
def status_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.processed_files(log(spark, sf_dir))


@query(f"""WITH {LOG} SELECT count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'processing') AS processing,
  count(*) FILTER (status = 'pending') AS pending, coalesce(sum(chunks_count) FILTER (status = 'completed'), 0)::BIGINT AS total_chunks FROM state""")
def status_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.stats(state.processed_files(log(spark, sf_dir)))


_RUNS = f"""WITH {LOG}, last AS (SELECT run_id, file_path, arg_max(event, seq) AS event, min(ts) AS a, max(ts) AS b FROM log GROUP BY ALL)
SELECT run_id, count(*) AS total_files, count(*) FILTER (event = 'completed') AS completed_files, count(*) FILTER (event = 'failed') AS failed_files, min(a) AS started_at, max(b) AS finished_at FROM last GROUP BY run_id"""


@query(_RUNS)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.run_summary(log(spark, sf_dir))


@query(f"{_RUNS} ORDER BY started_at DESC, run_id LIMIT 5")
def runs_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the five runs that began last."""
    return state.run_summary(log(spark, sf_dir)).orderBy(F.desc("started_at"), "run_id").limit(5)


@query(f"WITH {LOG} SELECT file_path, retry_count, error_msg FROM state WHERE status = 'failed' AND retry_count < 12")
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.retryable(state.processed_files(log(spark, sf_dir)), 12).select("file_path", "retry_count", "error_msg")


@query(f"WITH {LOG} SELECT file_path, retry_count, error_msg FROM state WHERE status = 'failed' AND retry_count >= 12")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.dead_letters(state.processed_files(log(spark, sf_dir)), 12).select("file_path", "retry_count", "error_msg")


@query(f"WITH {LOG} SELECT CASE status WHEN 'processing' THEN 'pending' ELSE status END AS status, count(*) AS n FROM state GROUP BY 1")
def stale_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.stale_reset(state.processed_files(log(spark, sf_dir))).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {LOG} SELECT round(100.0::DOUBLE * count(*) FILTER (status = 'completed') / (SELECT count(*) FROM documents), 1) AS percent FROM state")
def progress_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = state.processed_files(log(spark, sf_dir)).agg(F.count_if(F.col("status") == "completed").alias("done"))
    total = table(spark, sf_dir, "documents").agg(F.count("*").alias("total"))
    return done.crossJoin(total).select(F.round(F.lit(100.0) * F.col("done") / F.col("total"), 1).alias("percent"))


@query("SELECT event_type AS key, arg_max(value::VARCHAR, (ts, value::VARCHAR)) AS value, max(epoch_us(ts)) AS updated_at FROM (SELECT event_type, ts, user_id AS value FROM events) GROUP BY event_type")
def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest(table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("user_id").cast("string").alias("value"), text.micros("ts").alias("updated_at")))


_FAILED = f"""WITH {LOG}, e AS (SELECT error, lower(error) AS low, 'x.' || ['pdf', 'txt', 'hwp'][seq % 3 + 1] AS f FROM log WHERE event = 'failed')"""
_CASE = """CASE WHEN error IS NULL OR error = '' THEN 'unknown' WHEN contains(error, 'too short') THEN 'too short' WHEN contains(error, 'unsupported') THEN 'unsupported'
  WHEN contains(low, 'encoding') OR contains(low, 'codec') THEN 'encoding' WHEN contains(low, 'embedding') THEN 'embedding' WHEN contains(low, 'store') THEN 'store'
  WHEN contains(low, 'conversion') OR contains(low, 'convert') THEN 'conversion' ELSE substr(error, 1, 60) END"""


@query(f"{_FAILED} SELECT {_CASE} AS category, count(*) AS n FROM e GROUP BY 1")
def failure_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.failures(log(spark, sf_dir).where("event = 'failed'"), text.failure_category("error"), "category")


@query(f"{_FAILED} SELECT regexp_extract(f, '(\\.[^.]+)$', 1) AS ext, count(*) AS n FROM e GROUP BY 1")
def failure_by_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("x."), F.element_at(F.array(F.lit("pdf"), F.lit("txt"), F.lit("hwp")), (F.col("seq") % 3 + 1).cast("int")))
    return ingest.failures(log(spark, sf_dir).where("event = 'failed'"), text.suffix(path), "ext")


@query("""WITH files AS (SELECT doc_id, coalesce(text, '') || chr(10) AS body FROM documents)
SELECT doc_id, md5(replace(replace(body, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text_md5, strlen(body) AS length FROM files WHERE strlen(body) > 400""")
def files_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a text file that a task writes, found by tasks and read back in parts of 1 MB; files of up to 400 bytes are
    filtered out and never opened."""
    top = new_folder(spark)
    sources.write_texts(table(spark, sf_dir, "documents"), f"{top}/in", "doc_id", "text")
    found = sources.scan_by_tasks(spark, f"{top}/in", [".txt"]).select("path", "ext", "length")
    listed = reader.listed(found, 1 << 20)
    folders = written(found.select(F.regexp_extract("path", "^(.*)/", 1).alias("path")).distinct())
    dropped(found)
    rows = reader.read(spark, listed).where(F.col("length") > 400)
    doc_id = F.nullif(F.regexp_extract("path", "-doc_id=(-?[0-9]*)[.]txt$", 1), F.lit("")).cast("long")
    out = written(rows.select(doc_id.alias("doc_id"), F.md5("text").alias("text_md5"), "length"))
    sources.delete_folders(folders)
    dropped(folders)
    for folder in (top, listed.folder):
        deleted(spark, folder)
    return out
