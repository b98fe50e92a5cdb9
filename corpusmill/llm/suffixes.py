"""Exact repeated passages by suffix order and longest-previous-factor arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, give_back, small_batches, written

LENGTH, GRAM = 200, 48
_CHUNK = 1 << 19
_BITS = 1 << 27
_LOW = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = _CHUNK + 4 * LENGTH
    up = np.multiply.accumulate(np.full(n, np.uint64(_BASE)))
    down = np.multiply.accumulate(np.full(n, np.uint64(pow(_BASE, -1, 1 << 64))))
    return up, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays of (key, first, windows, anchor) for each chunk of a text's bytes.

    The anchor of a window of `length` bytes is its `gram`-byte run with the least hash, the leftmost of
    equals: equal windows have equal anchors at equal places. Consecutive windows with the same anchor
    are a segment: `windows` of them from byte `first`; `key` is the hash of the anchor's bytes."""
    up, down = _powers()
    w = length - gram + 1
    for at in range(0, len(data) - length + 1, _CHUNK):
        x = np.frombuffer(data, np.uint8, min(len(data) - at, _CHUNK + length - 1), at)
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * up[: len(x)], out=sums[1:])
        h = sums[gram:] - sums[:-gram]
        h *= down[: len(h)]
        h = _mixed(h)
        n = len(h)
        key = np.full(-(-n // w) * w, np.uint64(2**64 - 1))
        np.bitwise_or(h & ~_LOW, np.arange(n, dtype=np.uint64), out=key[:n])
        blocks = key.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
        place = (least & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        yield h[place[first]].view(np.int64), first + at, np.diff(np.r_[first, len(place)]), place[first] + at


def _slices(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Batches cut to `rows`, so that what a worker holds beside them is small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows].reset_index(drop=True)


def longest_previous(positions: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """The longest-previous-factor array, cut at `least`: for suffixes in their order, at `positions` in
    the text, where `common[i]` is the length of the prefix that suffix i shares with the one before.

    An earlier match of a suffix is longest at the previous or the next smaller position in suffix order.
    Both are found by jumps: from a neighbour with a larger position to that one's own previous (next)
    smaller one, of which none goes where less than `least` is shared. 0 where no match is as long."""
    n = len(positions)
    out = np.zeros(n, np.int64)
    for step in (-1, 1):
        to = np.arange(n) + step
        shared = np.zeros(n, np.int64)
        shared[max(0, -step) : n - max(0, step)] = common[1:]
        to[shared < least] = -1
        live = np.flatnonzero(to >= 0)
        while len(live := live[to[live] >= 0]) and len(live := live[positions[to[live]] > positions[live]]):
            shared[live] = np.minimum(shared[live], shared[to[live]])
            to[live] = to[to[live]]
        np.maximum(out, np.where(to >= 0, shared, 0), out=out)
    return out


def _runs(of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, first, end) of the runs of consecutive numbers `at` with equal `of`; both sorted."""
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)]) if len(of) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(of)] - 1
    return of[first], at[first], (at[last] + 1) if len(of) else first


def matched_windows(segments: pd.DataFrame, length: int, earlier: bool) -> pd.DataFrame:
    """h, s1, s2, lo, hi: the runs of windows of each distinct segment (h, s1, s2, doc_id, uid, first, m,
    times, data) that occur in another one too (`earlier`: at a smaller position). The suffixes that start
    at the windows are put in order to the depth of `length`; their longest-previous-factor array has the
    matches at smaller positions, and that of the positions in reverse those at larger ones."""
    segments = segments.sort_values(["h", "doc_id", "uid", "first"]).reset_index(drop=True)
    m = segments["m"].to_numpy(np.int64)
    text = np.frombuffer(b"".join(segments["data"]), np.uint8)
    starts = np.r_[0, np.cumsum(m + length - 1)]
    segment = np.repeat(np.arange(len(m)), m)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(m) - m, m)
    rank = np.empty(len(segment), np.int64)
    places = [segments["doc_id"].to_numpy(np.int64)[segment], segments["uid"].to_numpy(np.int64)[segment], segments["first"].to_numpy(np.int64)[segment] + window]
    rank[np.lexsort(places[::-1])] = np.arange(len(segment))
    group = segments["h"].to_numpy(np.int64)
    cuts, last = [0], 0
    for k in np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1:  # groups together, up to some number of windows
        if (ends := int(m[:k].sum())) - last > 30_000 or k == len(m):
            cuts.append(ends)
            last = ends
    hit = np.zeros(len(segment), bool)
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        suffix = view[starts[segment[a:b]] + window[a:b]]
        order = np.argsort(np.ascontiguousarray(suffix).view(f"S{length}").ravel(), kind="stable")
        differs = suffix[order[1:]] != suffix[order[:-1]]
        common = np.r_[0, np.where(differs.any(1), differs.argmax(1), length)]
        place = rank[a:b][order]
        found = longest_previous(place, common, length) >= length
        if not earlier:
            found |= longest_previous(-place, common, length) >= length
        hit[a:b][order] = found
    which, lo, hi = _runs(segment[hit], window[hit])
    return segments.loc[which, ["h", "s1", "s2"]].assign(lo=lo, hi=hi)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """2^27 bits (16 MB, whatever the number of keys) of which those of the long `key`s are set: a sieve
    that lets all keys pass and, the fewer they are, few others. What passes is then joined exactly.
    It reaches the driver as at most 1024 rows of 16 KB."""
    at = F.pmod("key", F.lit(_BITS))
    rows = keys.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    rows = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).withColumn("part", F.shiftright("word", 11).cast("int"))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(2048, np.int64)
        out[part["word"].to_numpy() & 2047] = part["bits"].to_numpy()
        return pd.DataFrame({"part": part["part"].iloc[:1], "bits": [out.tobytes()]})

    parts = rows.groupBy("part").applyInPandas(packed, "part int, bits binary").toArrow()
    out = np.zeros((_BITS >> 17, 2048), np.uint64)
    for part, bits in zip(parts["part"], parts["bits"], strict=True):
        out[part.as_py()] = np.frombuffer(bits.as_buffer(), np.uint64)
    return out.reshape(-1)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) & np.uint64(_BITS - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _place_key(uid: np.ndarray | int, first: np.ndarray) -> np.ndarray:
    return _mixed(np.asarray(uid, np.int64).view(np.uint64) + np.asarray(first).astype(np.uint64) * np.uint64(_BASE)).view(np.int64)


def repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int = GRAM, hot: int = 4096) -> DataFrame:
    """doc_id, uid, spans (array of struct(a, b), sorted, byte offsets from 0, b not included) of what repeats in
    `docs` (doc_id, uid, text): keep="none" has all bytes covered by strings of `length` bytes that start
    anywhere else too, keep="first" leaves the first of equal strings, by doc_id and place.

    1. Windows of `length` bytes fall into segments with a common anchor; only windows with equal anchors
       can be equal. Anchors are counted: one long each is shuffled, summed before.
    2. A second scan keeps the segments whose anchor occurs again, a third the bytes of those to compare;
       each time a sieve of fixed size says which, so texts are not shuffled.
    3. Equal segments repeat as a whole. Segments with equal anchors that differ are compared window by
       window: their suffixes are put in order, and longest-previous-factor arrays have the earlier
       matches. An anchor with more than `hot` different segments is not gathered: its windows are
       counted by content instead, with the same result."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select("doc_id", "uid", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            found = [a[0] for t in batch["text"] for a in anchors((t or "").encode(), length, gram)]
            yield pd.DataFrame({"key": np.concatenate([np.zeros(0, np.int64), *found])})
        give_back()

    shared = docs.select("text").mapInPandas(keys, "key long").groupBy("key").count().where(F.col("count") > 1)
    sieve = spark.sparkContext.broadcast(_bitmap(shared))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _slices(batches):
            columns: list[list] = [[] for _ in range(7)]
            for doc_id, uid, text in zip(part["doc_id"], part["uid"], part["text"], strict=True):
                data = (text or "").encode()
                for key, first, m, _ in anchors(data, length, gram):
                    some = _passes(sieve.value, key)
                    key, first, m = key[some], first[some], m[some]
                    both = [xxhash.xxh3_128_intdigest(data[a : a + n + length - 1]) for a, n in zip(first.tolist(), m.tolist(), strict=True)]
                    sides = np.array([x >> 64 for x in both], np.uint64), np.array([x & (1 << 64) - 1 for x in both], np.uint64)
                    for column, values in zip(columns, (np.full(len(key), doc_id), np.full(len(key), uid), key, sides[0].view(np.int64), sides[1].view(np.int64), first, m), strict=True):
                        column.append(values)
            yield pd.DataFrame({name: np.concatenate(c) if c else [] for name, c in zip(["doc_id", "uid", "h", "s1", "s2", "first", "m"], columns, strict=True)})
        give_back()

    found = written(docs.mapInPandas(candidates, f"doc_id {kind}, uid long, h long, s1 long, s2 long, first long, m long"))
    sieve.destroy()
    same = ["h", "s1", "s2"]
    segments = found.groupBy(*same).agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "uid", "first", "m")).alias("p"))
    segments = written(segments.select(*same, "times", "p.*"))
    groups = segments.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("times").alias("all"))
    groups = groups.where(F.col("kinds") > 1)
    looked_up = written(segments.join(groups.select("h", "kinds"), "h"))
    wanted = looked_up.select("uid", "first")
    row = ["doc_id", "uid"]

    def place_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": _place_key(batch["uid"].to_numpy(), batch["first"].to_numpy())})

    sieve2 = spark.sparkContext.broadcast(_bitmap(wanted.mapInPandas(place_keys, "key long")))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            out = []
            for doc_id, uid, text in zip(batch["doc_id"], batch["uid"], batch["text"], strict=True):
                data = (text or "").encode()
                for _, first, m, _ in anchors(data, length, gram):
                    for i in np.flatnonzero(_passes(sieve2.value, _place_key(uid, first))).tolist():
                        out.append((doc_id, uid, int(first[i]), data[first[i] : first[i] + m[i] + length - 1]))
            yield pd.DataFrame(out, columns=["doc_id", "uid", "first", "data"])
        give_back()

    data = docs.mapInPandas(cut_out, f"doc_id {kind}, uid long, first long, data binary").dropDuplicates([*row, "first"])
    mixed = written(looked_up.join(data, [*row, "first"]))
    sieve2.destroy()
    usual = mixed.where(F.col("kinds") <= hot)
    bins = max(1, -(-usual.count() // 4_000))
    by_order = usual.withColumn("bin", F.pmod("h", F.lit(bins))).drop("kinds").groupBy("bin").applyInPandas(lambda x: matched_windows(x, length, keep == "first"), "h long, s1 long, s2 long, lo long, hi long")
    by_content = _counted(mixed.where(F.col("kinds") > hot), length, keep == "first")
    runs = written(by_order.unionByName(by_content))
    partly = runs.groupBy(*same).agg(F.collect_list(F.struct("lo", "hi")).alias("parts"))
    known = segments.join(partly, same, "left").where((F.col("times") > 1) | F.col("parts").isNotNull())
    # Written, so that both sides of the join are dealt out for it and a hot segment's rows can be split.
    known = written(known.select(*same, "times", "parts", F.struct(*row, "first").alias("_at")))
    hits = found.join(known, same)
    full = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("m").alias("hi")))
    if keep == "first":
        parts = F.when(F.struct(*row, "first") == F.col("_at"), F.coalesce("parts", F.array().cast("array<struct<lo:long,hi:long>>"))).otherwise(full)
    else:
        parts = F.when(F.col("times") > 1, full).otherwise(F.col("parts"))
    spans = hits.select(*row, "first", F.explode(parts).alias("part")).select(*row, F.struct((F.col("first") + F.col("part.lo")).alias("a"), (F.col("first") + F.col("part.hi") + length - 1).alias("b")).alias("span"))
    spans = written(spans.groupBy(*row).agg(F.sort_array(F.collect_set("span")).alias("spans")))
    dropped(found, segments, looked_up, mixed, runs, known)
    return spans


def _counted(segments: DataFrame, length: int, earlier: bool) -> DataFrame:
    """As `matched_windows`, for anchors with any number of different segments: windows are counted by a
    128-bit hash of their bytes, summed before the shuffle."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for h, s1, s2, doc_id, uid, first, m, data in zip(*(batch[c] for c in ("h", "s1", "s2", "doc_id", "uid", "first", "m", "data")), strict=True):
                for i in range(m):
                    both = xxhash.xxh3_128_intdigest(data[i : i + length])
                    out.append((h, s1, s2, i, (both >> 64) - (1 << 63), (both & (1 << 64) - 1) - (1 << 63), doc_id, uid, first + i))
            yield pd.DataFrame(out, columns=["h", "s1", "s2", "i", "w1", "w2", "doc_id", "uid", "at"])

    rows = segments.mapInPandas(windows, f"h long, s1 long, s2 long, i long, w1 long, w2 long, doc_id {segments.schema['doc_id'].dataType.simpleString()}, uid long, at long")
    place = F.struct("doc_id", "uid", "at")
    classes = rows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(place).alias("least")).where(F.col("n") > 1)
    hits = rows.join(classes, ["w1", "w2"])
    if earlier:
        hits = hits.where(place != F.col("least"))
    return hits.select("h", "s1", "s2", F.col("i").alias("lo"), (F.col("i") + 1).alias("hi"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans that overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, each grown to the borders of the UTF-8 characters that it begins or ends within."""
    out = []
    for a, b in runs:
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        out.append((a, b))
    return merged(out)


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", whole: bool = False) -> DataFrame:
    """The columns of `docs` (doc_id, text and any others) with `kept` (binary: the bytes that stay),
    n_bytes, n_removed, n_spans (columns of these names are replaced); for `keep` see `repeats`. With
    `whole`, characters that a removed run begins or ends within go with it, so `kept` is UTF-8 again.

    Texts are taken as UTF-8 and null as empty; matches stay within documents. Texts shorter than
    `length` never match. Rows with equal doc_id and text repeat each other, and are one document where
    the first is kept. A null doc_id comes first. An empty table gives an empty one.

    Only texts with repeats move: those whose key passes a sieve of fixed size meet their spans."""
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans").withColumns({"_uid": F.xxhash64("doc_id", "text"), "_doc": F.coalesce("doc_id", F.lit(-(2**63)))})
    spans = repeats(docs.select(F.col("_doc").alias("doc_id"), F.col("_uid").alias("uid"), "text"), length, keep).withColumnsRenamed({"doc_id": "_doc", "uid": "_uid", "spans": "_spans"})
    sieve = docs.sparkSession.sparkContext.broadcast(_bitmap(spans.select(F.col("_uid").alias("key"))))

    @F.pandas_udf("boolean")
    def may_repeat(uid: pd.Series) -> pd.Series:
        return pd.Series(_passes(sieve.value, uid.to_numpy()))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            rows = []
            for text, spans_ in zip(batch["text"], batch.pop("_spans"), strict=True):
                data = (text or "").encode()
                runs = merged([(s["a"], s["b"]) for s in spans_]) if spans_ is not None else []
                runs = whole_characters(data, runs) if whole else runs
                ends = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                rows.append((kept, len(data), len(data) - len(kept), len(runs)))
            batch[["kept", "n_bytes", "n_removed", "n_spans"]] = pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans"], index=batch.index)
            yield batch

    docs = docs.withColumn("_may", may_repeat("_uid"))
    moved = docs.where("_may").drop("_may").join(spans, ["_doc", "_uid"], "left").drop("_doc", "_uid")
    moved = moved.mapInPandas(cut, moved.drop("_spans").withColumns({"kept": F.lit(b""), "n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")}).schema)
    every = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rest = docs.where(~F.col("_may")).drop("_may", "_doc", "_uid").withColumns({"kept": every, "n_bytes": F.octet_length(every).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")})
    return moved.unionByName(rest)
