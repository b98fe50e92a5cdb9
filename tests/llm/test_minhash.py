import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import minhash

from .conftest import prose


def brute(texts, percent=85):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def edited(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    base = [prose(k, 180, 10_000) for k in range(4)]
    texts = [prose(50 + k, 60, 10_000) for k in range(20)]
    texts += [edited(base[k % 3], k % 7, k) for k in range(80)]
    texts += [None, "", " \n", "One TWO", "one two", "one two three", base[0].upper(), base[3], base[3], base[3] + " tail of five more words", "É a b c d", "é a b c d"]
    return texts


@pytest.mark.parametrize("block", [10**6, 3000])
def test_components(make, block):
    texts = corpus()
    rows = minhash.near_duplicates(make(texts).withColumn("component_id", F.lit("clash")), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(brute(texts)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)


def test_threshold_is_exact(make):
    words = [f"w{i}" for i in range(104)]  # 100 shingles; 8 at an end apart: 92 of 108 in common
    a, b, c = " ".join(words), " ".join(words[:-8] + [f"v{i}" for i in range(8)]), " ".join(words[:-9] + [f"u{i}" for i in range(9)])
    rows = {r.doc_id: r.component_id for r in minhash.near_duplicates(make([a, b, c])).collect()}
    assert rows == {0: 0, 1: 0, 2: brute([a, b, c])[2][1]}


def test_edges(spark, make):
    assert minhash.near_duplicates(make([])).count() == 0
    rows = make(["a b c d e f", "x"]).union(make(["a b c d e f"])).union(make(["a b c d e f"]).withColumn("doc_id", F.lit(None).cast("long")))
    got = minhash.near_duplicates(rows).collect()
    assert len(got) == 4 and [r.kept for r in got if r.doc_id is None] == [True] and [r.component_id for r in got if r.doc_id == 0] == [0, 0]
    assert minhash.near_duplicates(make(["word " * 30_000, "word " * 30_001])).where("component_id = 0").count() == 2


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.label for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}


def test_signatures_estimate_likeness():
    a, b = minhash.shingles(prose(1, 600, 10_000)), minhash.shingles(edited(prose(1, 600, 10_000), 20, 1))
    import numpy as np

    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((minhash.signature(a, 2000) == minhash.signature(b, 2000)).mean() - true) < 0.05


def test_labels_do_not_pass_through_the_driver(spark, monkeypatch):
    """Small labels, too, are merged and not broadcast, round after round."""
    plans, write = [], minhash.written
    monkeypatch.setattr(minhash, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")
    found = {r.node: r.label for r in minhash.components(edges).collect()}
    assert found == dict.fromkeys(range(13), 0)
    assert len(plans) > 2 and not any("BroadcastExchange" in p for p in plans)
