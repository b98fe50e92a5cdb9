"""Queries by name, each with the DuckDB SQL that has the same rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or a temporary one under a local
    master where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, base, True)
    return f"{base.rstrip('/')}/files-{uuid.uuid4().hex}"


#: No table has files: each document stands in for one, with a name, folder and times made of its columns.
EXTENSIONS = [".hwp", ".doc", ".docx", ".PPT", ".pptx", ".xls", ".xlsx", ".pdf", ".txt", ".sql", ".md", ".jpg"]
NAMES = ["proposal v03", "design ver 1.2b", "report(final)", "src_20190412", "manual ver2.10", "meeting[2]", "latest", "contract-draft", "misc ", "report ver20230101120000", "plan\u3000ver\u30002.1", "guide Ver\u00a03.07c", "notes\u2003v12"]
FOLDERS = ["(2015.3 - 2016.11) Core  System", "2004년", "__team-", "Portal Renewal", "plan 1987 to 2031", "(2015.3\u00a0- 2016.11)\u3000Core"]
ROOT = "/corpus"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda xs, k: F.element_at(F.array(*map(F.lit, xs)), (F.col("doc_id") % k + 1).cast("int"))
    path = F.concat_ws("/", F.lit(ROOT), pick(FOLDERS, len(FOLDERS)), F.concat(F.lit("(2011.1 - 2012.2) "), F.col("source"), F.lit(" "), (F.col("doc_id") % 50 + 1985).cast("string")), F.col("lang"), F.concat(pick(NAMES, len(NAMES)), F.lit("_"), F.col("doc_id").cast("string"), pick(EXTENSIONS, 12)))
    return table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), F.col("n_chars").alias("length"), (F.lit(1_600_000_000_000_000) + F.col("doc_id") * 3_600_000_000).alias("modificationTime"))


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


FILES = f"""files AS (
  SELECT doc_id, '{ROOT}/' || {_list(FOLDERS)}[doc_id % {len(FOLDERS)} + 1] || '/(2011.1 - 2012.2) ' || source || ' ' || (doc_id % 50 + 1985)::VARCHAR || '/' || lang || '/'
    || {_list(NAMES)}[doc_id % {len(NAMES)} + 1] || '_' || doc_id::VARCHAR || {_list(EXTENSIONS)}[doc_id % 12 + 1] AS path,
    n_chars AS length, 1600000000000000 + doc_id * 3600000000 AS mtime
  FROM documents
), named AS (SELECT *, split(path, '/')[-1] AS name, lower(regexp_extract(path, '[^/.][^/]*?(\\.[^./]+)$', 1)) AS ext FROM files)"""

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


#: Events as a log of status changes: a user is a file.
STATUS = {"view": "processing", "click": "processing", "purchase": "completed", "signup": "completed", "error": "failed"}


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])[F.col("event_type")]
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("file-"), F.col("user_id").cast("string")).alias("file_path"),
        F.md5(F.col("value").cast("int").cast("string")).alias("file_hash"),
        status.alias("event"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.col("value").cast("int")).alias("chunks"),
        F.when(F.col("event_type") == "error", F.concat(F.element_at(F.array(*map(F.lit, ERRORS)), (F.col("event_id") % len(ERRORS) + 1).cast("int")), F.lit(" "), (F.col("event_id") % 7).cast("string"))).alias("error"),
        F.concat(F.lit("run-"), F.floor(F.col("event_id") / 1000).cast("string")).alias("run_id"),
        (text.micros("ts") / F.lit(1_000_000.0)).alias("ts"),
    )


ERRORS = ["empty or too short", "unsupported format", "Codec failed", "embedding timeout", "store is locked", "could not Convert", "disk full: no space is left on the device that holds the collection, try later", ""]
LOG = f"""log AS (
  SELECT event_id AS seq, 'file-' || user_id::VARCHAR AS file_path, md5(trunc(value)::INT::VARCHAR) AS file_hash,
    CASE WHEN event_type IN ('view', 'click') THEN 'processing' WHEN event_type IN ('purchase', 'signup') THEN 'completed' ELSE 'failed' END AS event,
    CASE WHEN event_type IN ('purchase', 'signup') THEN trunc(value)::INT END AS chunks,
    CASE WHEN event_type = 'error' THEN {_list(ERRORS)}[event_id % {len(ERRORS)} + 1] || ' ' || (event_id % 7)::VARCHAR END AS error,
    'run-' || (event_id // 1000)::VARCHAR AS run_id, epoch_us(ts) / 1000000.0::DOUBLE AS ts
  FROM events
), processed AS (
  SELECT file_path, arg_max(file_hash, seq) AS file_hash, arg_max(event, seq) AS status,
    coalesce(max(struct_pack(seq, chunks)) FILTER (event = 'completed'), NULL).chunks AS c,
    (max(struct_pack(seq, error)) FILTER (event IN ('completed', 'failed'))).error AS error_msg,
    count(*) FILTER (event = 'failed')::INT AS retry_count, arg_max(run_id, seq) AS run_id, arg_max(ts, seq) AS updated_at
  FROM log GROUP BY file_path
), state AS (SELECT * EXCLUDE (c), coalesce(c, 0)::INT AS chunks_count FROM processed)"""
