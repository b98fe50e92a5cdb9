import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import treaps

from .conftest import DOCS

ITEMS = "item_id long, text string"


def terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute(docs, items, k=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [b.total() for _, b in bags if b]
    n_docs, length = len(sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, words in items.items():
        scored = []
        for doc_id, b in bags:
            m = 50 + (50 * b.total() * n_docs) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in words if b[t])
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    rows = [(i, t, "en", "s", None) for i, t in docs]
    got = treaps.search(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), **kw)
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    return [(i, " ".join(f"W{int(rng.paretovariate(0.9)) % vocabulary}" for _ in range(rng.randrange(1, 80)))) for i in range(n)]


@given(st.lists(st.integers(0, 9), max_size=60))
def test_treap(impacts):
    """In order, the nodes are the places; no child is larger, and no left child as large."""
    left, right = treaps.treap(impacts)
    below = {x for x in left + right if x >= 0}
    roots = [i for i in range(len(impacts)) if i not in below]
    assert len(roots) == (1 if impacts else 0)

    def walk(i):
        return [] if i < 0 else [*walk(left[i]), i, *walk(right[i])]

    assert [x for r in roots for x in walk(r)] == list(range(len(impacts)))
    assert all(impacts[c] <= impacts[i] for i in range(len(impacts)) for c in (left[i], right[i]) if c >= 0)
    assert all(impacts[left[i]] < impacts[i] for i in range(len(impacts)) if left[i] >= 0)


def shard(rows):
    names = ["shard", "row", "doc_id", "term", "impact"]
    return pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)}, pa.schema([("shard", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("term", pa.string()), ("impact", pa.int64())]))


@pytest.mark.parametrize("wide", [1 << 22, 0])
def test_walk_finds_the_best_and_leaves_out_the_rest(monkeypatch, wide):
    monkeypatch.setattr(treaps, "_WIDE", wide)
    rng, rows, scores = np.random.default_rng(3), [], Counter()
    for d in range(3000):
        for t, weight in (("a", 3), ("b", 5), ("c", 1)):
            if rng.random() < 0.5:
                rows.append((0, d, d, t, x := int(rng.pareto(1.2) * 100) + 1))
                scores[d] += weight * x
    trees = treaps.Trees(treaps._built(shard(rows)))
    places, got = trees.best(["a", "b", "c"], [3, 5, 1], 10, 0)
    want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert got.tolist() == [s for _, s in want]
    assert trees.looked < 1500
    for floor in (want[4][1], want[0][1] + 1):
        assert trees.best(["a", "b", "c"], [3, 5, 1], 10, floor)[1].tolist() == [s for _, s in want if s >= floor]


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "block": 2, "first": 3}, {"shard": 1, "block": 1, "first": 1}])
def test_against_brute_force(spark, sizes):
    docs = corpus(1, 60)
    items = [(n, " ".join(f"w{(n * 7 + j) % 66}" for j in range(n))) for n in range(8)]
    want = brute(docs, {i: set(terms(t)) for i, t in items}, 7)
    assert found(spark, docs, items, k=7, **sizes) == want


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(None, "alpha beta"), (3, "alpha"), (3, "alpha"), (2, "ALPHA!"), (9, None), (8, ""), (7, "-- ..."), (6, "Ünï alpha " * 20_000), (5, "x1_x2"), (4, "beta"), (10, "gamma"), (11, "gamma")]
    items = [(1, "alpha"), (1, "beta"), (None, "x2 ünï Ünï"), (2, None), (3, "nowhere"), (4, "")]
    want = brute(docs, {1: {"alpha", "beta"}, None: {"x2", "ünï", "Ünï"}})
    assert found(spark, docs, items) == want


def test_a_term_of_all_documents_weighs_nothing(spark):
    assert found(spark, [(i, "same") for i in range(600)], [(1, "same")]) == []


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    for d, q in ((docs, items), (some, items), (docs, spark.createDataFrame([(1, "a")], ITEMS))):
        got = treaps.search(d, q)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_extra_columns(spark):
    names = {"term": F.lit(1), "shard": F.lit(2), "query": F.lit("x"), "n": F.lit(3), "row": F.lit(4)}
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3), (2, "a", "en", "s", 1), (3, "c", "en", "s", 1)], DOCS).withColumns(names)
    got = treaps.search(docs, spark.createDataFrame([(5, "b")], ITEMS).withColumns(names))
    assert [(r.item_id, r.rank, r.doc_id) for r in got.collect()] == [(5, 1, 1)]
