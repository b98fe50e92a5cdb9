"""Queries over chunks, vectors and texts."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from html import unescape

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import bpe, text, vectors
from ..operators import chunking, embedding, search, vector_index
from ..operators.tables import dropped, small_batches, written
from ..sources import compound
from ..sources.files import converted
from ..streaming.ingest import file_stream, ingest
from .registry import query, shared_folder, strip_sql, table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


_CHUNKS = f"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), cut AS (SELECT doc_id, source, unnest(range(0, CASE WHEN n <= 1000 THEN 1 ELSE 1 + ceil((n - 1000) / 800.0)::BIGINT END)) AS k, text FROM d
), stripped AS (SELECT doc_id, source, k, {strip_sql('substr(text, k * 800 + 1, 1000)')} AS text FROM cut
), chunks AS (SELECT doc_id, source, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS total_chunks, text FROM stripped WHERE text <> '')"""


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunked(_docs(spark, sf_dir), separators=None, source="source")


@query(f"{_CHUNKS} SELECT doc_id, chunk_index::INT AS chunk_index, total_chunks::INT AS total_chunks, text FROM chunks")
def chunk_fixed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_index", "total_chunks", "text")


@query(f"{_CHUNKS} SELECT doc_id, chunk_index::INT AS chunk_index, md5(coalesce(source, 'unknown') || ':' || chunk_index::VARCHAR || ':' || substr(text, 1, 50)) AS chunk_id FROM chunks")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_index", "chunk_id")


@query(f"{_CHUNKS} SELECT d.source, coalesce(n, 0) AS chunks FROM (SELECT DISTINCT source FROM documents) d LEFT JOIN (SELECT source, count(*) AS n FROM chunks GROUP BY 1) c ON d.source = c.source")
def chunks_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _chunks(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"))
    return _docs(spark, sf_dir).select("source").distinct().join(counts, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("chunks"))


@query()
def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunked(_docs(spark, sf_dir), source="source")


@query("""WITH RECURSIVE items AS (
  SELECT CASE WHEN doc_id % 10 > 0 THEN 'hot' ELSE source END AS source, doc_id, ceil(strlen(coalesce(text, '')) / 4.0)::BIGINT AS tokens FROM documents
), placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM items
), fold AS (
  SELECT source, doc_id, tokens, k, 0::BIGINT AS batch, tokens AS s, 1::BIGINT AS n FROM placed WHERE k = 1
  UNION ALL
  SELECT i.source, i.doc_id, i.tokens, i.k, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN f.batch + 1 ELSE f.batch END,
    CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN i.tokens ELSE f.s + i.tokens END, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 16 THEN 1 ELSE f.n + 1 END
  FROM fold f JOIN placed i ON i.source = f.source AND i.k = f.k + 1
) SELECT source, doc_id, tokens, batch FROM fold""")
def token_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sources; one of them has nine rows of ten."""
    source = F.when(F.col("doc_id") % 10 > 0, "hot").otherwise(F.col("source"))
    items = _docs(spark, sf_dir).select(source.alias("source"), "doc_id", text.estimated_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    return chunking.token_batches(items, ["source"], ["doc_id"], "tokens", 8000, 16)


def _counter(spark: SparkSession):
    return bpe.token_counter(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-pair tokens: beyond SQL, so the tests hold them against the library of the vocabulary."""
    return _docs(spark, sf_dir).select("doc_id", "source", _counter(spark)("text").alias("tokens"))


@query()
def token_batches_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written, as a sort by range reads its input twice.
    items = written(_docs(spark, sf_dir).select("source", "doc_id", _counter(spark)("text").alias("tokens")))
    out = chunking.token_batches(items, ["source"], ["doc_id"], "tokens")
    dropped(items)
    return out


@query("""WITH RECURSIVE items AS (SELECT doc_id, ceil(strlen(coalesce(text, '')) / 4.0)::BIGINT AS tokens, row_number() OVER (ORDER BY doc_id) AS k FROM documents
), fold AS (
  SELECT doc_id, tokens, k, 0::BIGINT AS batch, tokens AS s, 1::BIGINT AS n FROM items WHERE k = 1
  UNION ALL
  SELECT i.doc_id, i.tokens, i.k, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 64 THEN f.batch + 1 ELSE f.batch END,
    CASE WHEN f.s + i.tokens > 8000 OR f.n >= 64 THEN i.tokens ELSE f.s + i.tokens END, CASE WHEN f.s + i.tokens > 8000 OR f.n >= 64 THEN 1 ELSE f.n + 1 END
  FROM fold f JOIN items i ON i.k = f.k + 1
) SELECT doc_id, tokens, batch, 64 AS dimension FROM fold""")
def embed_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches and vectors of all documents under one rate (high, as no service is asked)."""
    docs = _docs(spark, sf_dir).select("doc_id", "text", text.estimated_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    made = embedding.embedded_by_budget(docs, ["doc_id"], "tokens", dimension=64, max_items=64, rate=6e9, requests=6e6)
    return made.select("doc_id", "tokens", "batch", F.size("embedding").alias("dimension"))


@query("SELECT source, sum(ceil(strlen(coalesce(text, '')) / 4.0))::BIGINT AS tokens FROM documents GROUP BY source")
def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).groupBy("source").agg(F.sum(text.estimated_tokens(F.coalesce("text", F.lit("")))).alias("tokens"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("chunk_id"), "embedding", "label", F.concat(F.lit("text "), F.repeat(F.lit("x"), (F.col("vec_id") % 600).cast("int"))).alias("text"), F.when(F.col("vec_id") % 11 > 0, F.concat(F.lit("project "), F.col("label").cast("string"))).alias("project"), F.concat(F.lit("file "), F.col("vec_id").cast("string"), F.lit(".txt")).alias("file_name"))


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(table(spark, sf_dir, "embeddings").where("vec_id = 7").first()["embedding"])


_SCORED = """WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 7), scored AS (
  SELECT vec_id AS chunk_id, label, list_cosine_similarity(embedding::DOUBLE[], v) AS s, 'text ' || repeat('x', (vec_id % 600)::INT) AS text,
    CASE WHEN vec_id % 11 > 0 THEN 'project ' || label::VARCHAR END AS project, 'file ' || vec_id::VARCHAR || '.txt' AS file_name FROM embeddings, q
)"""


@query(f"{_SCORED} SELECT chunk_id, round(s, 6) AS score FROM scored ORDER BY s DESC, chunk_id LIMIT 10")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(_vectors(spark, sf_dir), _query_vector(spark, sf_dir)).select("chunk_id", F.round("score", 6).alias("score"))


@query(f"{_SCORED} SELECT chunk_id, round(s, 6) AS score FROM scored WHERE label = 3 ORDER BY s DESC, chunk_id LIMIT 10")
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.matching(_vectors(spark, sf_dir), label=3, project=None, file_name="")
    return search.top_k(rows, _query_vector(spark, sf_dir)).select("chunk_id", F.round("score", 6).alias("score"))


@query("""WITH s AS (SELECT q.vec_id AS query_id, v.vec_id AS chunk_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM s)
SELECT query_id, chunk_id, round(s, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 10""")
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    queries = rows.where("chunk_id % 100 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    return search.top_k_each(rows, queries).withColumn("score", F.round("score", 6))


_EACH = """WITH s AS (SELECT q.vec_id AS query_id, v.vec_id AS chunk_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM s)
SELECT query_id, chunk_id, round(s, 6) AS score, rank::INT AS rank FROM r WHERE rank <= 10"""


def _indexed(spark: SparkSession, sf_dir: str, exact: bool) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    queries = rows.where("chunk_id % 100 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    held = vector_index.built(rows.select("chunk_id", "embedding"), vector_index.centres(rows, 32))
    probe = None if exact else vector_index.probe_for(held, queries, 0.95)
    return vector_index.search(held, queries, probe=probe).withColumn("score", F.round("score", 6))


@query(_EACH)
def vector_index_all_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with all its lists is exact."""
    return _indexed(spark, sf_dir, True)


@query()
def vector_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many of the nearest lists as a recall of 0.95 takes."""
    return _indexed(spark, sf_dir, False)


@query(f"{_SCORED} SELECT chunk_id, substr(text, 1, 500) AS text, round(s, 4) AS score, coalesce(project, '') AS project, file_name FROM scored ORDER BY s DESC, chunk_id LIMIT 25")
def search_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.shown(search.top_k(_vectors(spark, sf_dir), _query_vector(spark, sf_dir), 25), "project", "file_name")


@query("""SELECT vec_id AS chunk_id, label FROM embeddings WHERE vec_id % 3 <> 0 UNION ALL SELECT vec_id, label + 100 FROM embeddings WHERE vec_id % 3 = 0 UNION ALL SELECT vec_id + 1000000, label FROM embeddings WHERE vec_id % 5 = 0""")
def vector_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "label")
    new = rows.where("chunk_id % 3 = 0").withColumn("label", F.col("label") + 100).union(rows.where("chunk_id % 5 = 0").withColumn("chunk_id", F.col("chunk_id") + 1_000_000))
    return search.upsert(rows, new)


@query("SELECT count(*) AS n FROM embeddings")
def vector_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").agg(F.count("*").alias("n"))


@query("SELECT vec_id, round(embedding[1]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS first, round(embedding[64]::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS last FROM embeddings")
def vector_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", vectors.unit(F.col("embedding")).alias("u"))
    return rows.select("vec_id", F.round(F.col("u")[0], 6).alias("first"), F.round(F.col("u")[63], 6).alias("last"))


@query("""WITH r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rank FROM embeddings), c AS (
  SELECT label, string_agg('### [' || rank::VARCHAR || '] ' || CASE WHEN vec_id % 11 > 0 THEN 'project ' || label::VARCHAR ELSE 'unknown' END || ' / file ' || vec_id::VARCHAR || '.txt' || chr(10) || 'text ' || repeat('x', (vec_id % 600)::INT), chr(10) || chr(10) ORDER BY rank) AS context FROM r WHERE rank <= 5 GROUP BY label)
SELECT label, '## Context' || chr(10) || chr(10) || context || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '## Question' || chr(10) || chr(10) || 'What is ' || label::VARCHAR || '?' || chr(10) AS prompt FROM c""")
def rag_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("label").orderBy("chunk_id"))
    rows = _vectors(spark, sf_dir).withColumn("rank", rank).where("rank <= 5")
    found = search.context(rows, ["label"])
    return found.select("label", search.prompt(F.col("context"), F.concat(F.lit("What is "), F.col("label").cast("string"), F.lit("?"))).alias("prompt"))


@query(f"{_SCORED} SELECT coalesce(project, '') AS project, file_name, round(s, 4) AS score FROM scored ORDER BY s DESC, chunk_id LIMIT 10")
def answer_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.top_k(_vectors(spark, sf_dir), _query_vector(spark, sf_dir))
    return search.shown(found, "project", "file_name").select("project", "file_name", "score")


@query(f"""WITH l AS (SELECT doc_id, list_distinct(split(text, chr(10))) AS x, split(text, chr(10)) AS lines FROM documents),
o AS (SELECT doc_id, list_filter(lines, lambda v, i: list_position(lines, v) = i) AS lines FROM l)
SELECT doc_id, array_to_string(list_filter(list_transform(lines, lambda v: {strip_sql('v')}), lambda v: v <> ''), chr(10)) AS text FROM o""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.distinct_lines("text").alias("text"))


@query(f"SELECT doc_id, {strip_sql('''replace(replace(coalesce(text, ''), '|', chr(92) || '|'), chr(10), ' ')''')} AS text FROM documents")
def markdown_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.md_escape("text").alias("text"))


@query(f"SELECT doc_id, text AS stored, coalesce(nullif({strip_sql('text')}, ''), ' ') AS encoded, replace(substr(text, 1, 200), chr(10), ' ') AS preview FROM documents")
def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    preview = F.replace(F.substring("text", 1, 200), F.lit("\n"), F.lit(" "))
    return _docs(spark, sf_dir).select("doc_id", text.for_store("text").alias("stored"), text.for_tokenizer("text").alias("encoded"), preview.alias("preview"))


@query("SELECT key, sum(n)::BIGINT AS n FROM (SELECT lang AS key, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT role, count(*) FROM conversations GROUP BY 1) GROUP BY key")
def union_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("key")).agg(F.count("*").alias("n"))
    two = table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("key")).agg(F.count("*").alias("n"))
    return one.unionByName(two).groupBy("key").agg(F.sum("n").alias("n"))


def _bare_html(data: bytes) -> str:
    import re

    body = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", data.decode("utf-8", "replace"))
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", body)).split())


@query()
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The converter registry with one more format."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.lit(".html").alias("ext"), F.encode("html", "UTF-8").alias("content"))
    return converted(pages, {".html": _bare_html}).select("page_id", "text", "error")


def _contained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as a word-processor file: packed or not, and every fiftieth with a directory that leads to itself."""
    for batch in batches:
        out = []
        for doc_id, body in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            packed = doc_id % 4 > 0
            data = compound.build({"FileHeader": bytes(36) + bytes([packed]) + bytes(219), "BodyText/Section0": compound.hwp_section(body or "", packed), "DocInfo": b"x" * (doc_id % 9000)})
            if doc_id % 50 == 0:
                directory, table = struct.unpack_from("<I", data, 48)[0], struct.unpack_from("<I", data, 76)[0]
                at = (table + 1) * 512 + 4 * directory
                data = data[:at] + struct.pack("<I", directory) + data[at + 4 :]
            out.append(data)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([".hwp"] * len(out)), pa.array(out, pa.binary())], ["doc_id", "ext", "content"])


@query(r"""WITH d AS (SELECT doc_id, regexp_replace(replace(coalesce(text, ''), chr(13), chr(10)), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text FROM documents)
SELECT doc_id, CASE WHEN doc_id % 50 > 0 THEN CASE WHEN """ + strip_sql("text") + r""" = '' THEN '' ELSE text END END AS text, CASE WHEN doc_id % 50 = 0 THEN 'conversion: Damaged: chain without an end' END AS error FROM d""")
def compound_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    held = _docs(spark, sf_dir).select("doc_id", "text").mapInArrow(_contained, "doc_id long, ext string, content binary")
    return converted(held).select("doc_id", "text", "error")


@query()
def embed_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedded(_docs(spark, sf_dir).select("doc_id", "text"), dimension=64).select("doc_id", "embedding")


@query()
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as text files by Spark, a file a source and task, and taken in by the stream: the
    outcomes by reason, and how many chunks they gave."""
    top = shared_folder(spark)
    _docs(spark, sf_dir).select("source", F.coalesce("text", F.lit("")).alias("value")).write.partitionBy("source").text(f"{top}/files")
    taken = ingest(file_stream(spark, f"{top}/files"), f"{top}/chunks", f"{top}/status", f"{top}/checkpoint")
    taken.awaitTermination()
    read = lambda name: spark.read.option("recursiveFileLookup", True).parquet(f"{top}/{name}")
    files_ = read("status").groupBy("status").agg(F.count("*").alias("files"))
    return files_.crossJoin(read("chunks").agg(F.count("*").alias("chunks")))
