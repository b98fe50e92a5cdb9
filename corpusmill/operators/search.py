"""Vectors with metadata: upsert, exact cosine search, and prompts from what is found."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.vectors import cosine

_TEMPLATE = "## Context\n\n{context}\n\n---\n\n## Question\n\n{query}\n"
NOTHING_FOUND = "No documents were found for this question."


def upsert(existing: DataFrame, new: DataFrame, key: str = "chunk_id", order: str | None = None) -> DataFrame:
    """`existing` with the rows of `new` in place of those with the same key; write it to a new folder. Of the rows of
    `new` with one key the last write wins: that with the greatest `order`, or the last in the table."""
    names = existing.columns
    last = new.select(*names, (F.col(order) if order else F.monotonically_increasing_id()).alias("_order"))
    last = last.groupBy(key).agg(F.max_by(F.struct(*names), "_order").alias("_row")).select("_row.*")
    return existing.join(new.select(key), key, "left_anti").select(*names).unionByName(last)


def replace_sources(existing: DataFrame, new: DataFrame, source: str = "source_path") -> DataFrame:
    """As `upsert`, by source: chunks that a shorter version no longer has go, too."""
    return existing.join(new.select(source).distinct(), source, "left_anti").select(*existing.columns).unionByName(new.select(*existing.columns))


def matching(vectors: DataFrame, **equal: str | int | None) -> DataFrame:
    """Rows with these values; None and empty ones are no filter."""
    for name, value in equal.items():
        if value is not None and value != "":
            vectors = vectors.where(F.col(name) == F.lit(value))
    return vectors


def top_k(vectors: DataFrame, query: list[float], k: int = 10, key: str = "chunk_id") -> DataFrame:
    """The k rows with the largest cosine with one query vector, as `score`; ties by key. Each task keeps k."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    return vectors.withColumn("score", cosine(F.col("embedding"), literal)).orderBy(F.desc("score"), key).limit(k)


#: Rows of vectors, and queries, that a task holds against each other, about.
PART_ROWS, BLOCK_QUERIES = 1 << 16, 1 << 12


def top_k_each(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "chunk_id", query_key: str = "query_id", block: int = BLOCK_QUERIES, part_rows: int = PART_ROWS) -> DataFrame:
    """query_key, key, score, rank: the k rows of `vectors` nearest to each query by cosine (ties by key), all of them
    compared. As in `top_k`, the score is 0 where either vector is null, all zeros, has a null or another length.

    Vectors and queries are dealt by hash into parts and blocks of bounded size; each part meets each block in a task, with a matrix
    product, and passes on at most k rows a query. Nothing goes through the driver."""
    parts = max(1, -(-vectors.count() // part_rows))
    dealt = vectors.select(F.lit(0).alias("list"), F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"), key, "embedding")
    asked = queries.select(F.lit(0).alias("list"), query_key, "embedding")
    return best_of_parts(dealt, asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))), k, key, query_key, max(1, -(-queries.count() // block)))


def best_of_parts(vectors: DataFrame, asked: DataFrame, k: int, key: str, query_key: str, blocks: int) -> DataFrame:
    """The k nearest for each query: `vectors` (list, part, key, embedding) against the rows of `asked` (list, part, query_key, embedding) with
    the same list and part. Queries are dealt into `blocks`, and each part of vectors goes to each of them."""
    kinds = {**dict(vectors.dtypes), query_key: dict(asked.dtypes)[query_key]}
    schema = f"`{query_key}` {kinds[query_key]}, `{key}` {kinds[key]}, score double"
    left = vectors.withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = asked.select(F.col("list").alias("_list"), F.col("part").alias("_part"), F.col(query_key).alias("_query"), F.col("embedding").alias("_wanted"), F.pmod(F.xxhash64(query_key), F.lit(blocks)).alias("_block"))

    def nearest(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(wanted):
            return pd.DataFrame({query_key: [], key: [], "score": []})
        size = next((len(v) for v in wanted["_wanted"] if v is not None), 0)
        ids, places, v, found = wanted["_query"].to_numpy(), rows[key].to_numpy(), _units(rows["embedding"], size), []
        q = _units(wanted["_wanted"], size)
        for at in range(0, len(q), 256):
            scores = q[at : at + 256] @ v.T
            n = min(k, scores.shape[1])
            least = -np.partition(-scores, n - 1, axis=1)[:, n - 1]
            i, j = np.nonzero(scores >= least[:, None])
            best = pd.DataFrame({query_key: ids[at + i], key: places[j], "score": scores[i, j]})
            found.append(best.sort_values([query_key, "score", key], ascending=[True, False, True]).groupby(query_key, dropna=False).head(k))
        return pd.concat(found)

    found = left.groupBy("list", "part", "side").cogroup(right.groupBy("_list", "_part", "_block")).applyInPandas(nearest, schema)
    rank = F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _units(vectors: pd.Series, size: int) -> np.ndarray:
    """Rows of length 1, or of zeros for what is no vector of `size` numbers."""
    m = np.zeros((len(vectors), size))
    for row, v in zip(m, vectors, strict=True):
        if v is not None and len(v) == size:
            row[:] = np.asarray(v, np.float64)
    m[~np.isfinite(m).all(1)] = 0
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def shown(found: DataFrame, *names: str, preview: int = 500) -> DataFrame:
    """Search results for display: the text's start, the score to four places, '' for missing metadata."""
    return found.select("chunk_id", F.substring("text", 1, preview).alias("text"), F.round("score", 4).alias("score"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names])


def context(ranked: DataFrame, group: list[str]) -> DataFrame:
    """For each group, `context`: its rows (rank, project, file_name, text), numbered and joined in order."""
    line = F.concat(F.lit("### ["), F.col("rank").cast("string"), F.lit("] "), F.coalesce("project", F.lit("unknown")), F.lit(" / "), F.coalesce("file_name", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")))
    rows = F.sort_array(F.collect_list(F.struct(F.col("rank").alias("rank"), line.alias("line"))))
    return ranked.groupBy(*group).agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n\n").alias("context"))


def prompt(context_: Column, query: Column, template: str = _TEMPLATE) -> Column:
    before, rest = template.split("{context}")
    middle, after = rest.split("{query}")
    return F.concat(F.lit(before), context_, F.lit(middle), query, F.lit(after))


def answer(found: DataFrame, query: str, llm: Callable[[str], str]) -> tuple[str, list[dict]]:
    """An answer from `llm` to one question over the few rows found, and their sources."""
    ranked = found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "chunk_id")))
    text = context(ranked, []).withColumn("prompt", prompt(F.col("context"), F.lit(query))).first()
    if not text["context"]:
        return NOTHING_FOUND, []
    sources = ranked.orderBy("rank").select("project", "file_name", F.round("score", 4).alias("score")).collect()
    return llm(text["prompt"]), [r.asDict() for r in sources]
