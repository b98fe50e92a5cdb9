"""Ranked lexical search over inverted treaps: each term's postings are a search tree by document and a heap by impact, and
the trees of a query's terms are walked together, leaving out what cannot enter the best k."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, small_batches, written

#: Postings in a shard of the index, about: what a task of the search has in memory.
SHARD = 1 << 17
#: Queries in a block, about: each block meets each shard in a task of its own.
QUERIES = 512
#: One in so many shards is searched first, for what the others have to beat.
FIRST = 16
#: Intervals that are looked into at a time, and the size from which those found last go first.
_BATCH, _WIDE = 64, 1 << 22

#: ASCII letters in lower case, digits and all that is not ASCII stay; the other bytes part terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))

_TREAPS = "shard long, term string, places array<int>, doc_ids array<long>, impacts array<long>, lefts array<int>, rights array<int>"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's different terms and how often it has them; an empty term first, as often as it has terms at all."""
    for b in batches:
        sizes, flat, times = [0], [], []
        for text in b.column("text").to_pylist():
            bag = Counter(terms(text or ""))
            if bag:
                flat += [b"", *bag]
                times += [bag.total(), *bag.values()]
            sizes.append(len(flat))
        offsets = pa.array(sizes, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), *lists], ["row", "doc_id", "terms", "times"])


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """row, doc_id, n (the document's terms with repeats), term, tf: for each row and each term of `wanted` (each once) in its
    text; the empty term's tf is n, in each text that has terms. `row` is new and tells rows with one doc_id apart."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    bags = rows.mapInArrow(_bags, "row long, doc_id long, terms array<string>, times array<long>")
    each = bags.select("row", "doc_id", F.get("times", F.lit(0)).alias("n"), F.inline(F.arrays_zip("terms", "times")).alias("term", "tf"))
    return each.join(wanted, "term")


def treap(impacts: list[int]) -> tuple[list[int], list[int]]:
    """Left and right children (-1: none) of the tree that is a heap by impact over places in order: a parent has no less
    than its children, and of equals the first is above."""
    left, right, open_ = [-1] * len(impacts), [-1] * len(impacts), []
    for i, x in enumerate(impacts):
        last = -1
        while open_ and impacts[open_[-1]] < x:
            last = open_.pop()
        left[i] = last
        if open_:
            right[open_[-1]] = i
        open_.append(i)
    return left, right


def _built(shard: pa.Table) -> pa.Table:
    rows, ids = shard.column("row").to_numpy(), shard.column("doc_id")
    null = ids.is_null().to_numpy()
    ids = ids.fill_null(0).to_numpy()
    names = shard.column("term").combine_chunks().dictionary_encode()
    words, impacts = names.indices.to_numpy(), shard.column("impact").to_numpy()
    # Documents are numbered by doc_id, null first, then by row.
    order = np.lexsort((rows, ids, ~null))
    new = np.ones(len(rows), bool)
    new[1:] = rows[order][1:] != rows[order][:-1]
    place = np.empty(len(rows), np.int32)
    place[order] = np.cumsum(new) - 1
    order = np.lexsort((place, words))
    place, ids, null, words, impacts = (x[order] for x in (place, ids, null, words, impacts))
    cuts = np.r_[np.flatnonzero(np.diff(words, prepend=-1)), len(words)]
    lefts, rights = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        left, right = treap(impacts[a:b].tolist())
        lefts += left
        rights += right
    offsets = pa.array(cuts, pa.int32())
    lists = [pa.array(place, pa.int32()), pa.array(ids, pa.int64(), mask=null), pa.array(impacts, pa.int64()), pa.array(lefts, pa.int32()), pa.array(rights, pa.int32())]
    whole = [pa.array([shard.column("shard")[0].as_py()] * (len(cuts) - 1), pa.int64()), names.dictionary.take(pa.array(words[cuts[:-1]]))]
    return pa.Table.from_arrays([*whole, *[pa.ListArray.from_arrays(offsets, x) for x in lists]], names=["shard", "term", "places", "doc_ids", "impacts", "lefts", "rights"])


def index(found: DataFrame, impact: Column, size: int = SHARD) -> tuple[DataFrame, int]:
    """The treaps of `found` postings, one row for each shard and term, and the number of shards. A shard holds whole
    documents, dealt by hash, so a term that all documents have is spread like any other."""
    real = found.where(F.col("term") != "")
    shards = max(1, -(-real.count() // size))
    dealt = real.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "doc_id", "term", impact.alias("impact"))
    return written(dealt.groupBy("shard").applyInArrow(_built, _TREAPS)), shards


class Trees:
    """The treaps of one shard. Nodes of all terms lie in one row of arrays; node 0 is none."""

    def __init__(self, table: pa.Table):
        self.slot = {t: k for k, t in enumerate(table.column("term").to_pylist())}
        flat = {c: table.column(c).combine_chunks().flatten() for c in ("places", "doc_ids", "impacts", "lefts", "rights")}
        lengths = table.column("places").combine_chunks().value_lengths().to_numpy()
        starts = np.cumsum(lengths) - lengths + 1
        shift = np.repeat(starts, lengths)
        child = lambda c: np.r_[0, np.where((x := flat[c].to_numpy()) < 0, 0, x + shift)].astype(np.int32)
        self.place = np.r_[-1, flat["places"].to_numpy()].astype(np.int64)
        self.impact = np.r_[0, flat["impacts"].to_numpy()]
        self.left, self.right = child("lefts"), child("rights")
        self.places = int(self.place.max()) + 1
        self.keys = np.r_[-1, np.repeat(np.arange(len(lengths)), lengths) * self.places + self.place[1:]]
        self.doc_ids = flat["doc_ids"]
        # No other node of its term has the root among its children.
        below = np.zeros(len(self.place), bool)
        below[self.left] = below[self.right] = True
        below[0] = True
        self.roots = np.flatnonzero(~below).astype(np.int32)
        self.looked = 0

    def _within(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The highest nodes with low <= place < high, each below the given one or itself."""
        flat, low, high = nodes.ravel().copy(), np.repeat(low, nodes.shape[1]), np.repeat(high, nodes.shape[1])
        at = np.flatnonzero(flat)
        while at.size:
            place = self.place[flat[at]]
            before, after = place < low[at], place >= high[at]
            flat[at] = np.where(before, self.right[flat[at]], np.where(after, self.left[flat[at]], flat[at]))
            at = at[(before | after) & (flat[at] > 0)]
        return flat.reshape(nodes.shape)

    def best(self, words: list[str], weights: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents with scores of `floor` (at least 1) or more, best first.

        An interval of places is known by the highest node that each term has in it, which holds the term's largest
        impact there; the sum of these bounds every score in the interval. The document of the largest part is scored and
        parts the interval in two. What stays below the k-th best so far is left out with all its subtrees."""
        slots = np.array([self.slot[w] for w in words])
        weight = np.array(weights, np.int64)
        nodes, low, high = self.roots[slots][None, :], np.zeros(1, np.int64), np.array([self.places])
        bound = (self.impact[nodes] * weight).sum(1)
        places, scores, least = np.empty(0, np.int64), np.empty(0, np.int64), max(floor, 1)
        while len(bound := bound[keep := bound >= least]):
            nodes, low, high = nodes[keep], low[keep], high[keep]
            if len(bound) > _BATCH and nodes.size < _WIDE:
                order = np.argpartition(bound, len(bound) - _BATCH)
                nodes, low, high, bound = nodes[order], low[order], high[order], bound[order]
            cut = max(0, len(bound) - _BATCH)
            mine, lo, hi = nodes[cut:], low[cut:], high[cut:]
            pivot = self.place[mine[np.arange(len(mine)), (self.impact[mine] * weight).argmax(1)]]
            wanted = slots * self.places + pivot[:, None]
            hit = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            score = (np.where(self.keys[hit] == wanted, self.impact[hit], 0) * weight).sum(1)
            self.looked += len(pivot)
            places, scores = np.r_[places, pivot], np.r_[scores, score]
            order = np.lexsort((places, -scores))[:k]
            places, scores = places[order], scores[order]
            if len(scores) == k:
                least = max(least, int(scores[-1]))
            below, above = self._within(mine, lo, pivot), self._within(mine, pivot + 1, hi)
            nodes = np.concatenate([nodes[:cut], below, above])
            low, high = np.concatenate([low[:cut], lo, pivot + 1]), np.concatenate([high[:cut], pivot, hi])
            bound = np.concatenate([bound[:cut], (self.impact[below] * weight).sum(1), (self.impact[above] * weight).sum(1)])
        keep = scores >= least if floor > 0 else scores > 0
        return places[keep], scores[keep]


def _searched(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query": [], "doc_id": [], "score": []}
        if left.num_rows and right.num_rows:
            trees = Trees(left)
            of_place = dict(zip(trees.place[1:].tolist(), range(trees.doc_ids.__len__())))
            by: dict[str, tuple[list[str], list[int], int]] = {}
            for q, term, weight, floor in zip(*[right.column(c).to_pylist() for c in ("query", "term", "weight", "floor")]):
                if term in trees.slot:
                    words, weights, _ = by.setdefault(q, ([], [], floor))
                    words.append(term)
                    weights.append(weight)
            for q, (words, weights, floor) in by.items():
                places, scores = trees.best(words, weights, k, floor)
                found["query"] += [q] * len(places)
                found["doc_id"] += trees.doc_ids.take(pa.array([of_place[p] for p in places.tolist()], pa.int64())).to_pylist()
                found["score"] += scores.tolist()
        return pa.table(found, pa.schema([("query", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return run


def _part(treaps: DataFrame, words: DataFrame, shards: Column, floors: DataFrame | None, k: int) -> DataFrame:
    """query, doc_id, score: each query's k best of each shard in `shards`, without what is below the query's floor."""
    asked = words.join(floors, "query", "left") if floors is not None else words.withColumn("floor", F.lit(None).cast("long"))
    asked = asked.select("block", "query", "term", "weight", F.coalesce("floor", F.lit(0)).cast("long").alias("floor"), F.explode(shards).alias("shard"))
    held = treaps.join(words.select(F.col("block").alias("side"), "term").distinct(), "term")
    return held.groupBy("shard", "side").cogroup(asked.groupBy("shard", "block")).applyInArrow(_searched(k), "query string, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 50, shard: int = SHARD, block: int = QUERIES, first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring rows of `docs` (doc_id, text) for each item of `queries` (item_id,
    text), equal scores by ascending doc_id (null first), scores above 0 only.

    Terms are runs of ASCII letters (of either case), digits and other than ASCII characters. A term's weight is
    floor(1000 * ln((2N + 2) / (2df + 1))), its impact (10^9 tf) div (1000 tf + 20 (50 + (50 n N) div L)).
    Rows without text or terms are found by nothing and count for nothing; repeated rows are found each; rows of `queries` that share an
    item_id are one item with the terms of all; an item without known terms has no rows. Empty tables give an empty one, other
    columns are not looked at.

    Both sides are dealt: documents into shards of about `shard` postings of the queries' terms, queries into blocks of about `block`. A part
    of the shards is searched first; its k-th best score is where the search of the others starts."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    # All else than ASCII counts as letters here; Java's own lower() would change it.
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = queries.select(name.alias("query"), F.explode(F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))).alias("term"))
    words = written(words.distinct())
    # As a table its size is known beforehand, so that a small one is sent to where the texts are.
    wanted = written(words.select("term").unionByName(docs.sparkSession.createDataFrame([("",)], "term string")).distinct())
    found = written(postings(docs, wanted))
    held = found.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("times"))
    n_docs, length = held.where(F.col("term") == "").select("df", "times").first() or (0, 1)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    blocks = max(1, -(-words.select("query").distinct().count() // block))
    known = written(words.join(held, "term").select("query", "term", weight.cast("long").alias("weight"), F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block")).where("weight > 0"))
    impact = F.expr(f"(1000000000L * tf) div (1000 * tf + 20 * (50 + (50 * n * {n_docs}L) div {length}L))")
    treaps, shards = index(found, impact, shard)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = lambda x: x.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    early = -(-shards // first)
    tables, rest = [words, wanted, found, known, treaps], None
    parts = written(top(_part(treaps.where(F.col("shard") < early), known, F.sequence(F.lit(0).cast("long"), F.lit(early - 1).cast("long")), None, k)).drop("rank"))
    tables.append(parts)
    if early < shards:
        floors = parts.groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("floor"))
        rest = _part(treaps.where(F.col("shard") >= early), known, F.sequence(F.lit(early).cast("long"), F.lit(shards - 1).cast("long")), floors, k)
        parts = parts.unionByName(rest)
    kind = queries.schema["item_id"].dataType
    result = written(top(parts).select(F.nullif("query", F.lit("")).cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    dropped(*tables)
    return result
