"""Search over all vectors and through the index."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import search, vector_index

SCHEMA = "chunk_id long, embedding array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("chunk_id"), "embedding")


def asked(vectors):
    return vectors.where("chunk_id % 100 = 0").withColumnRenamed("chunk_id", "query_id")


def found(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.chunk_id)
    return out


def test_odd_vectors_score_alike_alone_and_in_batches(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [-1.0, 0.0]), (4, [1.0, None]), (5, [1.0]), (6, [1.0, 0.0]), (7, [2.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = spark.createDataFrame([(10, [3.0, 0.0]), (11, None), (12, [0.0, 0.0])], "query_id long, embedding array<float>")
    each = search.top_k_each(df, queries, 8, block=1, part_rows=3).collect()
    one = {r.chunk_id: round(r.score, 6) for r in search.top_k(df, [3.0, 0.0], 8).collect()}
    assert {r.chunk_id: round(r.score, 6) for r in each if r.query_id == 10} == one == {0: 1, 6: 1, 7: 0.707107, 1: 0, 2: 0, 4: 0, 5: 0, 3: -1}
    assert [r.chunk_id for r in sorted(each, key=lambda r: r["rank"]) if r.query_id == 10] == [0, 6, 7, 1, 2, 4, 5, 3]
    assert all(r.score == 0 for r in each if r.query_id > 10) and len(each) == 24


def test_parts_and_blocks_change_nothing(vectors):
    want = found(search.top_k_each(vectors, asked(vectors)))
    assert len(want) == 20 and found(search.top_k_each(vectors, asked(vectors), block=3, part_rows=170)) == want


def test_recall_and_the_exact_way(vectors):
    queries, want = asked(vectors), found(search.top_k_each(vectors, asked(vectors)))
    index = vector_index.built(vectors, vector_index.centres(vectors, 32), part_rows=40)
    recall = lambda probe: np.mean([len({*got.get(q, ())} & {*want[q]}) / 10 for got in [found(vector_index.search(index, queries, probe=probe))] for q in want])
    probe = vector_index.probe_for(index, queries, 0.9, sample=15)
    assert 1 < probe < 32 and recall(probe) >= 0.9 > recall(1)
    assert found(vector_index.search(index, queries, probe=None, block=7)) == want


def test_index_of_odd_vectors_and_of_none(spark):
    rows = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])], SCHEMA)
    queries = spark.createDataFrame([(9, [1.0, 0.1]), (8, None)], "query_id long, embedding array<float>")
    index = vector_index.built(rows, vector_index.centres(rows, 2))
    got = vector_index.search(index, queries, k=5, probe=None).collect()
    assert sorted(r.chunk_id for r in got if r.query_id == 9) == [1, 2, 3, 3, 4] and len(got) == 10
    none = rows.limit(0)
    assert vector_index.search(vector_index.built(none, vector_index.centres(none, 2)), queries).count() == 0


def test_centres_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "MOST_NUMBERS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        vector_index.centres(spark.createDataFrame([(1, [1.0, 0.0])], SCHEMA), 2)


def test_the_recall_of_all_probes_is_one_search(vectors, monkeypatch):
    queries, calls, real = asked(vectors), [], vector_index.search
    index = vector_index.built(vectors, vector_index.centres(vectors, 32), part_rows=40)
    monkeypatch.setattr(vector_index, "search", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert vector_index.probe_for(index, queries, 0.9, sample=15) > 1 and len(calls) == 1
