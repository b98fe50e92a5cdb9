import math
import random

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import toxicity

from .conftest import prose


def graded(n, seed):
    """Texts with none, one or several of some bad words; every tenth bad one is a compound."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        grade = rng.choice([0, 0, 0, 1, 2, 3])
        bad = [rng.choice(["vile", "rotten", "nasty", "vermin", "vermintail", "verminhead"]) for _ in range((0, 2, 5, 12)[grade])]
        words = prose(seed * 10_000 + i, 60).replace("0", "a").replace("1", "b").replace("x", "y").split() + bad
        rng.shuffle(words)
        rows.append((i, " ".join(words), grade))
    return rows


def test_held_out_grades(spark):
    train = spark.createDataFrame(graded(1200, 1), "key long, text string, grade int")
    model = toxicity.fit(train, train, 'key')
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    test = spark.createDataFrame(graded(300, 2), "doc_id long, text string, grade int")
    rows = toxicity.score(test.withColumn("severity", F.lit("clash")), model).collect()
    mean = [np.mean([r.severity for r in rows if r.grade == g]) for g in range(4)]
    assert mean == sorted(mean) and mean[3] - mean[0] > 1.5
    assert np.mean([r.toxic == (r.grade > 0) for r in rows]) > 0.95
    again = toxicity.fit(train.repartition(5), train, 'key')
    assert np.allclose(model.weights, again.weights)


def test_edges(spark):
    train = spark.createDataFrame(graded(50, 1), "key long, text string, grade int")
    for rows in (train.limit(0), train.withColumn("grade", F.lit(0)), train.withColumn("grade", F.lit(None).cast("int")), train.withColumn("text", F.lit(None).cast("string"))):
        model = toxicity.fit(rows, rows, 'key')
        assert not model.weights.any()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 ..."), (3, "123 ..."), (None, "word " * 50_000)], "doc_id long, text string")
    scored = toxicity.score(docs, toxicity.fit(train, train, 'key')).collect()
    assert len(scored) == 5 and len({r.severity for r in scored if r.doc_id}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_sample_is_bounded(spark):
    train = spark.createDataFrame(graded(300, 1), "key long, text string, grade int")
    a, b = toxicity.fit(train, train, 'key', max_rows=100), toxicity.fit(train, train.orderBy(F.desc("key")), 'key', max_rows=100)
    assert np.allclose(a.weights, b.weights)


def loss(w, theta, texts, grades, odds, penalty=0.3):
    """The penalized negative log likelihood, a text at a time: w scales the odds of a text's features, each word's with repeats of a feature."""
    edge, out = [-math.inf, *theta, math.inf], 0.5 * penalty * sum(x * x for x in w.values())
    sigmoid = lambda t: 1.0 if t == math.inf else 0.0 if t == -math.inf else 1 / (1 + math.exp(-t))
    for text, grade in zip(texts, grades):
        eta = sum(w[f] * odds[f] for word in toxicity.words(text) for f in toxicity.features(word) if f in w)
        out -= math.log(max(sigmoid(edge[grade + 1] - eta) - sigmoid(edge[grade] - eta), 1e-12))
    return out


def test_the_fit_is_at_the_least_of_a_brute_force_likelihood(spark):
    rows = graded(400, 3)
    texts, grades, n = [t for _, t, _ in rows], [g for _, _, g in rows], len(rows)
    model = toxicity.fit(*[spark.createDataFrame(rows, "key long, text string, grade int")] * 2, "key", rounds=1500)
    seen = [{f for word in toxicity.words(t) for f in toxicity.features(word)} for t in texts]
    bad, odds = sum(g > 0 for g in grades), {}
    for f in set().union(*seen):
        times, hits = sum(f in s for s in seen), sum(f in s for s, g in zip(seen, grades) if g)
        a, b = hits + 3 * (bad + 1) / (n + 2), times - hits + 3 * (n - bad + 1) / (n + 2)
        x = math.log(a / (bad + 3)) - math.log(b / (n - bad + 3))
        if times >= 8 and x - 2.5 * math.sqrt(1 / a + 1 / b) >= 1:
            odds[f] = x
    assert {*np.flatnonzero(model.weights)} <= {*odds}
    w, theta = {f: model.weights[f] / x for f, x in odds.items()}, list(model.thresholds)
    best = loss(w, theta, texts, grades, odds)
    assert all(x >= 0 for x in w.values()) and best < loss({f: 0.5 for f in w}, theta, texts, grades, odds)
    rng = random.Random(4)
    for f in rng.sample(sorted(w), min(25, len(w))):
        for d in (-0.1, 0.1):
            assert loss(w | {f: max(w[f] + d, 0)}, theta, texts, grades, odds) >= best - 1e-3
    for k in range(len(theta)):
        for d in (-0.1, 0.1):
            moved = [x + d * (i == k) for i, x in enumerate(theta)]
            assert moved != sorted(moved) or loss(w, moved, texts, grades, odds) >= best - 1e-3
    got = toxicity.score(spark.createDataFrame(rows[:40], "key long, text string, grade int"), model).collect()
    for r in got:
        eta = sum(model.weights[f] for word in toxicity.words(r.text) for f in toxicity.features(word))
        assert abs(r.severity - sum(1 / (1 + math.exp(t - eta)) for t in theta)) < 1e-9
