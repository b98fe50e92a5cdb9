"""Near-duplicate documents by circulant MinHash: two permutations give all signature coordinates, bands
of them bring likely copies together, and links are confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, give_back, hash_bucket, hottest, running, small_batches, written

SHINGLE, PERCENT = 5, 85
#: 24 bands of 5 coordinates miss a pair at the threshold with probability (1 - 0.85^5)^24 < 1e-6.
BANDS, ROWS = 24, 5
#: Documents of one group that a task compares at once: of about so many shingles, 400 a document added.
_BLOCK = 600_000
_MANY = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of `size` words of a text, A-Z lower-cased; of all
    words as one where there are fewer; none of a null or blank text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, np.uint64(size))
    for k in range(size):
        out += h[k : len(h) - size + 1 + k] * _MANY[k]
    return np.unique(_mixed(out))


def signature(shingled: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash: a first permutation scatters the shingles over 2^32 places; coordinate k is the
    least value that a second permutation, circularly shifted by k, gives to a place of the set."""
    places = (shingled >> np.uint64(32)).astype(np.uint32) ^ shingled.astype(np.uint32)
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    for at in range(0, len(places), 4096):
        x = places[None, at : at + 4096] - shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(1), out=least)
    return least


def _sketched(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                s = shingles(text, size)
                if not len(s):
                    out.append((doc_id, 0, None, None, None))
                    continue
                both = xxhash.xxh3_128_intdigest(s.tobytes())
                keys = signature(s, bands * rows).reshape(bands, rows).astype(np.uint64)
                keys = _mixed((keys * _MANY[:rows]).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * _MANY[rows])
                out.append((doc_id, len(s), (both >> 64) - (1 << 63), (both & (1 << 64) - 1) - (1 << 63), keys.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n", "hi", "lo", "bands"])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n long, hi long, lo long, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """node, label of the nodes of `edges` (a, b): the smallest node that each is connected with. Each
    round takes the least label around a node and then that node's own; both are sums by key of rows,
    with a hot node summed before the shuffle. Rounds are written, as the next ones build on them.

    Labels are merged with what looks them up, small ones too: sent to all tasks instead, each round's would go through
    the driver, with a job and a thread for every join."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(edges.where(F.col("a") != F.col("b")).select(F.inline(ways)).distinct())
    table = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.lit(None).cast("long").alias("was"), F.least("node", "m").alias("label")))
    while True:
        labels = table.select("node", "label").hint("merge")
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), F.lit(None).cast("long").alias("was"), "label")
        new = table.select("node", F.col("label").alias("was"), "label").union(near).groupBy("node").agg(F.max("was").alias("was"), F.min("label").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up")).hint("merge")
        new = written(new.join(up, "label").select("node", "was", F.least("label", "up").alias("label")))
        dropped(table)
        table = new
        if table.where(F.col("was") != F.col("label")).isEmpty():
            dropped(both)
            return table.select("node", "label")


def _links(own: list[np.ndarray], other: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Pairs (i, j) of sets of `own` with those of `other` (or of `own`, i < j) whose intersection is at
    least `percent` of their union. Intersections are counted by products of the sets' rows over the
    shingles that two sets or more have, some thousand shingles at a time."""
    every = own + (other or [])
    sizes = np.array([len(s) for s in every])
    known, at, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(every)), sizes)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[at]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n = len(own)
    common = np.zeros((n, len(other) if other is not None else n), np.float32)
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        m = np.zeros((len(every), width), np.float32)
        m[row[a:b], column[a:b] - first] = 1
        used = np.flatnonzero(m[:n].any(1))
        if other is None:
            common[np.ix_(used, used)] += m[used] @ m[used].T
        else:
            theirs = np.flatnonzero(m[n:].any(1))
            common[np.ix_(used, theirs)] += m[used] @ m[n + theirs].T
    union = sizes[:n, None] + (sizes[None, n:] if other is not None else sizes[None, :]) - common
    linked = 100 * common >= percent * union
    if other is None:
        linked = np.triu(linked, 1)
    return np.argwhere(linked)


def _spanning(ids: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """(node, least node of its component) for the components that `pairs` of places in `ids` join."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in pairs.tolist():
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [(int(ids[i]), int(ids[find(i)])) for i in range(len(ids)) if find(i) != i]


def _confirmed(tasks: DataFrame, percent: int) -> DataFrame:
    """a, b: edges that span the linked documents of each task. `tasks` has task, cluster, side, node, set:
    within a cluster the sets of side 0 are compared with each other, and with those of side 1."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, part in batch.groupby("cluster", sort=False):
            part = part.sort_values("node").drop_duplicates(["node", "side"])
            first = part[part["side"] == 0]
            second = part[(part["side"] == 1) & ~part["node"].isin(first["node"])]
            own = [np.frombuffer(s, np.uint64) for s in first["set"]]
            ids = first["node"].to_numpy()
            if len(own) > 1:
                edges += _spanning(ids, _links(own, None, percent))
            if len(own) and len(second):
                pairs = _links(own, [np.frombuffer(s, np.uint64) for s in second["set"]], percent)
                pairs[:, 1] += len(own)
                edges += _spanning(np.concatenate([ids, second["node"].to_numpy()]), pairs)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return tasks.groupBy("task").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block: int = _BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of `docs` (doc_id long, text; others ignored).

    Documents are linked whose sets have 100 * intersection >= percent * union; component_id is the least
    doc_id that links lead to. Rows with equal doc_id are taken to have equal texts. Null and blank texts have empty sets and link with nothing; repeated rows
    are copies, with a row each; a null doc_id is its own component (null, and kept). An empty table
    gives an empty one.

    Equal sets become one node. Buckets of the bands join nodes into clusters (each bucket as a star,
    so a hot one is a sum by key), and all of a cluster is compared, in blocks of bounded size: a block
    with itself and with the cluster's first block. Where a cluster has several blocks, what is then
    outside its largest component is compared with every block: pairs within that component cannot
    change the result, so no link between components is lost. Tasks return spanning edges only."""
    small_batches(docs.sparkSession)
    sketched = written(_sketched(docs, size, bands, rows))
    some = sketched.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    nodes = some.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = written(nodes)
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    centers = buckets.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("m")).where(F.col("m") > 1)
    stars = buckets.join(centers, "bucket").where(F.col("node") != F.col("center")).select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    clusters = components(stars).join(nodes.select("node", "n"), "node").withColumnRenamed("label", "cluster")
    clusters = clusters.withColumn("_h", F.xxhash64("node"))
    spread = max(1, -(-hottest(clusters, ["cluster"]) // 2_000))
    clusters = running(clusters, ["cluster"], hash_bucket("_h", spread), ["_h", "node"], F.col("n") + 400, "_before")
    clusters = written(clusters.select("cluster", "node", "n", F.floor(F.col("_before") / block).cast("int").alias("block")))
    whole = clusters.groupBy("cluster").agg((F.max("block") + 1).alias("blocks"))

    def with_set(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500].copy()
                yield part.assign(set=[shingles(t, size).tobytes() for t in part.pop("text")])
        give_back()

    texts = docs.select(F.col("doc_id").alias("node"), "text").join(clusters.join(whole, "cluster"), "node")
    sets = texts.mapInPandas(with_set, texts.drop("text").withColumn("set", F.lit(b"")).schema)
    sets = written(sets)
    total = clusters.agg(F.sum(F.col("n") + 400)).first()[0] or 0
    bins = max(1, -(-total // block))
    at = F.when(F.col("blocks") == 1, F.array(F.struct(F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("task"), F.lit(0).alias("side"))))
    named = lambda k: F.concat_ws("-", "cluster", k)
    at = at.when(F.col("block") > 0, F.array(F.struct(named(F.col("block")).alias("task"), F.lit(0).alias("side"))))
    at = at.otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(named(k).alias("task"), F.when(k == 0, 0).otherwise(1).alias("side"))))
    first = written(_confirmed(sets.select("cluster", "node", "set", F.inline(at)), percent))
    labels = components(first)
    large = sets.where(F.col("blocks") > 1)
    if not large.isEmpty():
        inner = large.select("cluster", "node", "block", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        main = inner.groupBy("cluster", "label").count().groupBy("cluster").agg(F.max(F.struct("count", "label"))["label"].alias("main"))
        rest = inner.join(main, "cluster").where(F.col("label") != F.col("main")).withColumn("_h", F.xxhash64("node"))
        spread = max(1, -(-hottest(rest, ["cluster"]) // 2_000))
        rest = running(rest, ["cluster"], hash_bucket("_h", spread), ["_h", "node"], F.col("n") + 400, "_before")
        rest = written(rest.select("cluster", "node", F.floor(F.col("_before") / block).cast("int").alias("part")))
        parts = rest.groupBy("cluster").agg((F.max("part") + 1).alias("parts"))
        task = lambda p, b: F.concat_ws("-", "cluster", p, b)
        asked = large.join(rest, ["cluster", "node"]).withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cluster", "node", "set", task("part", "_b").alias("task"), F.lit(0).alias("side"))
        met = large.join(parts, "cluster").withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cluster", "node", "set", task("_p", "block").alias("task"), F.lit(1).alias("side"))
        second = written(_confirmed(asked.unionByName(met), percent))
        labels = components(first.union(second))
        dropped(rest, second)
    dropped(sets, clusters, first)
    found = nodes.join(labels, "node", "left").select("hi", "lo", F.coalesce("label", "node").alias("component_id"))
    out = sketched.where(F.col("doc_id").isNotNull()).drop("bands").join(found, ["hi", "lo"], "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = out.unionByName(sketched.where(F.col("doc_id").isNull()).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
