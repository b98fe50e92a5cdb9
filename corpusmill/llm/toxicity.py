"""Toxicity grades by cumulative-link ordinal regression on sparse word features."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

FEATURES = 1 << 18


@dataclass(frozen=True)
class Ordinal:
    """P(grade > k) = 1 / (1 + exp(thresholds[k] - sum of the weights of a text's features)): one weight for
    each feature is shared by the ordered thresholds. Of fixed size, whatever it was fitted on."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


_WORDS = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 500_000


def words(text: str | None) -> set[str]:
    """The distinct runs of letters of the whole text, lower-cased."""
    return set(_WORDS.findall((text or "").lower()))


def features(word: str) -> list[int]:
    """A word and its prefixes of 3 to 7 letters (compounds share their stem), hashed to `FEATURES` numbers."""
    parts = [word, *("^" + word[:k] for k in range(3, min(8, len(word))))]
    return [xxhash.xxh3_64_intdigest(x) % FEATURES for x in parts]


def _totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each feature its rows, and those of them above grade 0."""
    times, hits = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
    for batch in batches:
        for text, grade in zip(batch["text"], batch["grade"], strict=True):
            found = np.unique([f for w in words(text) for f in features(w)]).astype(np.int64)
            times[found] += 1
            hits[found] += grade > 0
    f = np.flatnonzero(times)
    yield pd.DataFrame({"f": f, "times": times[f], "hits": hits[f]})


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", max_rows: int = 10_000, least_documents: int = 8, penalty: float = 0.3, rounds: int = 400) -> Ordinal:
    """Fits the texts of `docs` (`key`, text) to `labels` (`key`, grade: int from 0; null grades teach nothing). A
    documented bound: of more than `max_rows` labels those with the least hash of `key` are taken, so that
    they can be sent to all tasks, no text moves for being looked up, and the driver's share does not grow.

    Features whose smoothed log odds among rows above grade 0 are surely (by 2.5 standard errors) 1 or more
    are scaled by these odds and get weights of 0 or more, so that no length of harmless text outweighs what is found; accelerated gradient
    steps on the penalized likelihood follow. With no rows, or with one grade only, all weights
    are 0 and the thresholds give the grades' shares."""
    small_batches(docs.sparkSession)
    sample = labels.where(F.col("grade").isNotNull() & F.col(key).isNotNull()).select(key, F.col("grade").cast("int").alias("grade"))
    sample = sample.orderBy(F.xxhash64(key), key, "grade").limit(max_rows)
    rows = written(docs.select(key, "text").join(F.broadcast(sample), key).select("text", "grade"))
    counts = rows.mapInPandas(_totals, "f int, times long, hits long").groupBy("f").agg(F.sum("times").alias("times"), F.sum("hits").alias("hits")).toPandas()
    times, hits = np.zeros(FEATURES), np.zeros(FEATURES)
    times[counts["f"]], hits[counts["f"]] = counts["times"], counts["hits"]
    n, bad = rows.count(), rows.where("grade > 0").count()
    a, b = hits + 3 * (bad + 1) / (n + 2), times - hits + 3 * (n - bad + 1) / (n + 2)
    odds = np.log(a / (bad + 3)) - np.log(b / (n - bad + 3))
    surely = odds - 2.5 * np.sqrt(1 / a + 1 / b)
    odds[(times < least_documents) | (surely < 1)] = 0
    used = np.flatnonzero(odds)

    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.array([f for w in words(t) for f in features(w) if odds[f]], np.int64) for t in batch["text"]]
            found = [np.unique(f, return_counts=True) for f in found]
            yield pd.DataFrame({"grade": batch["grade"], "f": [f.astype(np.int32) for f, _ in found], "n": [k.astype(np.int32) for _, k in found]})

    sample = rows.mapInPandas(chosen, "grade int, f array<int>, n array<int>").toPandas()
    grade = sample["grade"].to_numpy(np.int64)
    row = np.repeat(np.arange(len(sample)), [len(x) for x in sample["f"]])
    f, often = (np.concatenate([np.zeros(0, np.int64), *sample[c]]).astype(np.int64) for c in ("f", "n"))
    x, column = odds[f] * often, np.searchsorted(used, f)
    top = max(1, int(grade.max(initial=1)))
    share = [(np.sum(grade > k) + 0.5) / (n + 1) for k in range(top)]
    theta = np.maximum.accumulate(np.array([-np.log(s / (1 - s)) for s in share]) + 1e-3 * np.arange(top))
    w = np.full(len(used), 0.5)
    if not len(used) or not 0 < bad < n:
        return Ordinal(np.zeros(FEATURES), theta)
    per_row = np.bincount(row, np.abs(x), n)
    bound = 0.25 * np.bincount(column, np.abs(x) * per_row[row], len(used)) + penalty
    seen, seen_theta, momentum = w, theta, 1.0
    for _ in range(rounds):
        eta = np.bincount(row, x * seen[column], n)
        edge = np.r_[-np.inf, seen_theta, np.inf]
        s = lambda t: 1 / (1 + np.exp(-np.clip(t, -50, 50)))
        low, high = edge[grade], edge[np.minimum(grade, top) + 1]
        a, b = np.where(np.isinf(high), 1.0, s(high - eta)), np.where(np.isinf(low), 0.0, s(low - eta))
        p = np.maximum(a - b, 1e-9)
        step_w = (np.bincount(column, x * (1 - a - b)[row], len(used)) + penalty * seen) / bound
        da, db = np.where(np.isinf(high), 0.0, a * (1 - a)), np.where(np.isinf(low), 0.0, b * (1 - b))
        g = np.array([-(da / p)[grade == k].sum() + (db / p)[grade == k + 1].sum() for k in range(top)])
        steep = n * (0.5 + 1 / max(0.2, float(np.diff(seen_theta).min(initial=np.inf))) ** 2)
        new_w, new_theta = np.maximum(seen - step_w, 0), np.maximum.accumulate(seen_theta - g / steep + 1e-9 * np.arange(top))
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        seen = new_w + (momentum - 1) / faster * (new_w - w)
        seen_theta = np.maximum.accumulate(new_theta + (momentum - 1) / faster * (new_theta - theta))
        w, theta, momentum = new_w, new_theta, faster
    weights = np.zeros(FEATURES)
    weights[used] = w * odds[used]
    return Ordinal(weights, theta)


def score(docs: DataFrame, model: Ordinal, threshold: float = 0.5) -> DataFrame:
    """Adds severity (the expected grade), p_toxic = P(grade > 0) and toxic (p_toxic >= threshold) to
    `docs`, whose columns of these names are replaced. Null, empty and letterless texts score as a text of
    no features. Repeated rows score alike; an empty table stays empty."""
    small_batches(docs.sparkSession)
    docs = docs.drop("severity", "p_toxic", "toxic")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, known = shared.value, {}
        for batch in batches:
            eta = np.zeros(len(batch))
            for i, text in enumerate(batch["text"]):
                found = words(text)
                for w in found.difference(known):
                    known[w] = float(model.weights[features(w)].sum())
                eta[i] = math.fsum(map(known.__getitem__, found))
                if len(known) > _CACHED_WORDS:
                    known.clear()
            above = model.above(eta)
            yield batch.assign(severity=above.sum(1), p_toxic=above[:, 0], toxic=above[:, 0] >= threshold)

    return docs.mapInPandas(run, docs.withColumns({"severity": F.lit(0.0), "p_toxic": F.lit(0.0), "toxic": F.lit(False)}).schema)
