"""Search through an index: vectors lie in lists around centres, a query looks into the nearest lists, and what is there is
ranked by exact cosine. With all lists the search is exact."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import norm, unit
from .search import BLOCK_QUERIES, PART_ROWS, _units, best_of_parts
from .tables import written

#: Centres are sent to all tasks: this many numbers at most (256 MB).
MOST_NUMBERS = 1 << 25


def centres(vectors: DataFrame, lists: int, sample: int = 100_000, key: str = "chunk_id", seed: int = 1) -> np.ndarray:
    """Up to `lists` centres of k-means, at length 1, over the directions of `sample` vectors at most: those with the least
    hashes of `key`. Vectors that are null or zero are none. Only the centres reach the driver."""
    real = vectors.where(F.coalesce(norm(F.col("embedding")), F.lit(0.0)) > 0)
    some = real.orderBy(F.xxhash64(key), key).limit(sample).select(array_to_vector(unit(F.col("embedding"))).alias("features"))
    some = written(some)
    if some.isEmpty():
        return np.zeros((0, 0))
    size = len(some.first()["features"])
    if lists * size > MOST_NUMBERS:
        raise ValueError(f"{lists} centres of {size} numbers are more than {MOST_NUMBERS}")
    found = np.array(KMeans(k=lists, seed=seed, maxIter=20).fit(some).clusterCenters())
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)


def _nearest_lists(rows: DataFrame, middles: np.ndarray, n: int) -> DataFrame:
    """Adds lists, the `n` nearest to each vector; what is no vector of the centres' size is in list 0."""
    shared = rows.sparkSession.sparkContext.broadcast(middles)

    @F.pandas_udf("array<int>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for batch in batches:
            if not len(m):
                yield pd.Series([[0]] * len(batch))
                continue
            scores = _units(batch, m.shape[1]) @ m.T
            yield pd.Series(list(np.argsort(-scores, axis=1, kind="stable")[:, :n].astype(np.int32)))

    return rows.withColumn("lists", nearest("embedding"))


@dataclass(frozen=True)
class Index:
    """rows: list, part, the key and the vector of each row; parts: how many parts each list has."""

    rows: DataFrame
    parts: DataFrame
    middles: np.ndarray
    key: str


def built(vectors: DataFrame, middles: np.ndarray, key: str = "chunk_id", part_rows: int = PART_ROWS) -> Index:
    """Every vector in the list of its nearest centre. A list with many vectors lies in parts of about `part_rows` by hash of the
    key."""
    placed = _nearest_lists(vectors.select(key, "embedding"), middles, 1)
    placed = written(placed.select(F.col("lists")[0].alias("list"), key, "embedding"))
    parts = placed.groupBy("list").count().select("list", F.ceil(F.col("count") / part_rows).alias("parts"))
    rows = placed.join(F.broadcast(parts), "list")  # a row for each list
    return Index(rows.select("list", F.pmod(F.xxhash64(key), F.col("parts")).alias("part"), key, "embedding"), parts, middles, key)


def search(index: Index, queries: DataFrame, k: int = 10, probe: int | None = 8, query_key: str = "query_id", block: int = BLOCK_QUERIES) -> DataFrame:
    """query_key, key, score, rank: the k nearest by exact cosine among the vectors in the `probe` nearest lists of each query (None: in all
    lists, so that nothing is missed). Scores and ties are those of `operators.search.top_k_each`."""
    asked = queries.select(query_key, "embedding")
    if probe is None:
        asked = asked.crossJoin(F.broadcast(index.parts))  # a row for each list
    else:
        near = _nearest_lists(asked, index.middles, probe)
        asked = near.select(query_key, "embedding", F.explode("lists").alias("list")).join(F.broadcast(index.parts), "list")
    asked = asked.select("list", query_key, "embedding", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return best_of_parts(index.rows, asked, k, index.key, query_key, max(1, -(-queries.count() // block)))


def recall(found: DataFrame, exact: DataFrame, key: str, query_key: str = "query_id") -> float:
    """The part of `exact` that `found` has; 1 if there is nothing to find."""
    both = exact.select(query_key, key).join(found.select(query_key, key).withColumn("_hit", F.lit(1)), [query_key, key], "left")
    return both.agg(F.avg(F.coalesce("_hit", F.lit(0)))).first()[0] if not exact.isEmpty() else 1.0


def probe_for(index: Index, queries: DataFrame, least: float = 0.9, k: int = 10, sample: int = 64, query_key: str = "query_id") -> int:
    """How many lists to look into for a recall of `least`, measured against the exact way over the `sample` queries with the least
    hashes: the smallest of 1, 2, 3, 4, 6, 8, 12... that reaches it, or all lists."""
    some = written(queries.select(query_key, "embedding").orderBy(F.xxhash64(query_key), query_key).limit(sample))
    exact, lists, probe = written(search(index, some, k, None, query_key)), max(1, len(index.middles)), 1
    # A row of the exact result is found as soon as its list is looked into, so one pass tells the recall of any number of lists.
    near = _nearest_lists(some, index.middles, lists).select(query_key, F.posexplode("lists").alias("nth", "list"))
    held = index.rows.select(index.key, "list").join(F.broadcast(exact.select(query_key, index.key)), index.key)  # k rows a query
    first = held.join(F.broadcast(near), [query_key, "list"]).groupBy(query_key, index.key).agg(F.min("nth").alias("nth"))
    hits = dict(exact.join(F.broadcast(first), [query_key, index.key]).groupBy("nth").count().collect())  # a row for each list at most
    total = exact.count()
    while probe < lists and total and sum(n for nth, n in hits.items() if nth < probe) < least * total:
        probe = probe * 3 // 2 if probe & (probe - 1) == 0 and probe > 1 else max(probe + 1, probe // 3 * 4)
    return min(probe, lists)
