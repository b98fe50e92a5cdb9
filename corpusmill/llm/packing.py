"""Best-fit packing of tokenized documents into fixed-length sequences, in bulk-synchronous sweeps."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, give_back, hash_bucket, running, small_batches, written

#: Words that a worker keeps in one generation of its cache.
_CACHED_WORDS = 250_000
#: Where lower-casing first and cutting by `_WORDS` are what the tokenizer does: blanks, and letters and
#: marks below U+0250 but for other numbers, blanks and the dotted capital I.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]*")
#: The tokenizer's own pattern for words, for such text.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: The model's letters are bytes: those that print stand for themselves, the others for 256 and up, in order.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
#: Before a run of characters that the tokenizer must cut itself.
_WHOLE = "\0"


# The rules of tokenizer files that cut words as `_WORDS` does.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUTTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class _Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    A tokenizer with the rules above knows no context beyond a word, so a distinct word is encoded once while it
    stays in one of the two generations of the bounded cache: words used since the last change of generations
    outlive the next. A tokenizer with other rules encodes each text whole."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(Path(path).read_text(encoding="utf-8"))
        self.by_word = rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _CUTTER and rules["model"]["type"] == "BPE" and all(x["content"].startswith("<|") and not x["normalized"] and not x["lstrip"] and not x["rstrip"] for x in rules["added_tokens"])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        words = [self._words(x) for x in texts]
        if len(self.young) > _CACHED_WORDS:
            self.young, self.old = {}, self.young
        young = self.young
        unknown = set().union(*words).difference(young)
        if unknown:
            self._learn(unknown)
        return [b"".join(map(young.__getitem__, ws)) for ws in words]

    @staticmethod
    def _words(text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _WORDS.findall(text.lower())
        out = []
        for run in text.replace("\n", " ").split(" "):
            if _PLAIN.fullmatch(run) and "<|" not in run:
                out += _WORDS.findall(run.lower())
            else:
                out.append(_WHOLE + run)
        return out

    def _learn(self, unknown: set[str]) -> None:
        young, old, letters = self.young, self.old, []
        for w in unknown:
            if (ids := old.get(w)) is not None:
                young[w] = ids
            elif w.isalpha():
                letters.append(w)
            else:
                young[w] = array("I", self.tokenizer.encode(w.removeprefix(_WHOLE), add_special_tokens=False).ids).tobytes()
        model = self.tokenizer.model
        for w in letters:
            young[w] = array("I", [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(_BYTES))]).tobytes()


@cache
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def tokenized(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of at most `capacity` tokens of each row's
    text and the closing id `end`. Only what is longer is cut; the last piece may be shorter. A null
    or empty text is the closing id alone. `path` is the tokenizer's file, which every executor has."""
    small_batches(docs.sparkSession)
    close = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part, rows = batch.iloc[at : at + 512], []
                for doc_id, ids in zip(part["doc_id"], encode([x or "" for x in part["text"]]), strict=True):
                    ids += close
                    n = len(ids) // 4
                    rows += [(doc_id, k, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)])) for k, s in enumerate(range(0, n, capacity))]
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        encode.old = {}
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


#: Documents are packed by phases of falling length: those up to the capacity over each of these numbers.
_PHASES = (1, 2, 3, 5, 12, 48)


#: In all but the last phase, a sweep that places less than one in so many of the waiting pieces is its phase's last.
_FEW = 8


def _own(pieces: DataFrame, first: int, capacity: int) -> DataFrame:
    """length, rank, sequence_id and gap of the `pieces` (length, rank) that get new sequences, from `first` on: of each
    length as many as fill whole sequences, by rank; the few that are left have none. The first piece of a sequence has what is free in it."""
    by = pieces.groupBy("length").agg(F.min("rank").alias("_least"), F.count("*").alias("_n")).withColumn("_each", F.floor(F.lit(capacity) / F.col("length")))
    by = by.withColumn("_full", F.floor(F.col("_n") / F.col("_each")))
    before = F.coalesce(F.sum("_full").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by = by.select("length", "_least", "_each", "_full", before.alias("_before")).crossJoin(pieces.sparkSession.range(first, first + 1).withColumnRenamed("id", "_first"))
    by = F.broadcast(by)  # a row for each length
    at = F.floor((F.col("rank") - F.col("_least")) / F.col("_each"))
    own = F.when(at < F.col("_full"), F.col("_first") + F.col("_before") + at)
    free = F.when((at < F.col("_full")) & ((F.col("rank") - F.col("_least")) % F.col("_each") == 0), capacity - F.col("_each") * F.col("length"))
    return pieces.join(by, "length").select("length", "rank", own.alias("sequence_id"), free.alias("gap"))


def _classes(pieces: DataFrame, gaps: DataFrame, longest: int | None, per_bucket: int) -> DataFrame:
    """A row for each size of `gaps` (kind 0) and `pieces` (kind 1): its places a gap, its buckets, and the places less the pieces of all sizes before it."""
    count, whole = F.count("*").alias("count"), Window.partitionBy()
    classes = gaps.groupBy(F.col("gap").alias("size")).agg(count, F.lit(0).alias("kind"), F.lit(0).cast("long").alias("least"))
    classes = classes.unionByName(pieces.groupBy(F.col("length").alias("size")).agg(count, F.lit(1).alias("kind"), F.min("rank").alias("least")))
    top = F.max(F.when(F.col("kind") == 1, F.col("size"))).over(whole) if longest is None else F.lit(longest)
    classes = classes.withColumn("each", F.greatest(F.floor(F.col("size") / top), F.lit(1)))
    signed = F.when(F.col("kind") == 0, F.col("count") * F.col("each")).otherwise(-F.col("count"))
    before = F.coalesce(F.sum(signed).over(whole.orderBy(F.desc("size"), "kind").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return classes.select("size", "kind", "least", F.col("each").alias("_q"), F.ceil(F.col("count") / per_bucket).alias("_buckets"), before.alias("_before"))


def _matched(pieces: DataFrame, gaps: DataFrame, longest: int | None, per_bucket: int, classes: DataFrame | None = None) -> DataFrame:
    """One sweep: each of `pieces` (length, rank) is matched with the smallest gap of `gaps` (sequence_id, gap) that
    holds it and that no longer one takes; a gap for several of length `longest` (by default that of the longest piece) has a place for each.
    Returns the pieces with their sequence_id, null where none is left, and the places (the first of each gap has the gap).

    Places and pieces are sorted by size. In this order a piece closes the bracket that the last free
    place before it opens, which is its successor among the gaps. A class of equal sizes takes as many levels of
    nesting as it has rows, one for each rank, so the classes' running sums (a row for each size) give every row
    its level, and on a level what closes is right after what opens it. Levels have at most a row of each
    class, so neither a hot length nor a hot gap meets in one task.

    What changes from sweep to sweep is data, not part of the plan, so that its compiled code serves all of them. `classes`
    is what `_classes` returns, written: a sweep looks it up three times, and would plan and take it as often."""
    classes = _classes(pieces, gaps, longest, per_bucket) if classes is None else classes
    of = lambda kind, *columns: F.broadcast(classes.where(F.col("kind") == kind).select(F.col("size").alias("_size"), "_before", *columns))  # noqa: E731  at most a row for each size
    places = gaps.join(of(0, "_q", "_buckets"), F.col("gap") == F.col("_size")).withColumn("_h", F.xxhash64("sequence_id"))
    bucket = F.shiftright(F.shiftrightunsigned("_h", 33) * F.col("_buckets"), 31)
    places = running(places, ["gap"], bucket, ["_h", "sequence_id"], "_q", "_rank")
    below = F.col("_before") + F.col("_rank")
    places = places.select("sequence_id", "gap", F.posexplode(F.sequence(below + 1, below + F.col("_q"))).alias("_place", "level"))
    none = F.lit(None).cast("long")
    places = places.select("level", F.col("gap").alias("size"), F.lit(0).alias("kind"), none.alias("length"), none.alias("rank"), "sequence_id", F.when(F.col("_place") == 0, F.col("gap")).alias("gap"))
    pieces = pieces.join(of(1, "least"), F.col("length") == F.col("_size"))
    pieces = pieces.select((F.col("_before") - (F.col("rank") - F.col("least"))).alias("level"), F.col("length").alias("size"), F.lit(1).alias("kind"), "length", "rank", none.alias("sequence_id"), none.alias("gap"))
    found = F.lag("sequence_id").over(Window.partitionBy("level").orderBy(F.desc("size"), "kind"))
    return places.union(pieces).select("length", "rank", F.when(F.col("kind") == 0, F.col("sequence_id")).otherwise(found).alias("sequence_id"), "gap")


def _swept(step: DataFrame) -> DataFrame:
    """What `_matched` returns with the gaps as they are afterwards; full ones are left out."""
    # Pieces without a sequence need no partner; they are dealt by hash.
    apart = F.coalesce("sequence_id", -1 - F.pmod(F.xxhash64("length", "rank"), F.lit(1 << 20)))
    taken = F.coalesce(F.sum("length").over(Window.partitionBy(apart)), F.lit(0))
    return step.withColumn("gap", F.col("gap") - taken).where(F.col("length").isNotNull() | (F.col("gap") > 0))


def best_fit(pieces: DataFrame, capacity: int = 2048, seed: int = 29, per_bucket: int = 2_000) -> DataFrame:
    """Adds sequence_id and offset to `pieces` (doc_id, piece, length, any others), which are read
    several times and so should be a written table. Repeated rows get places of their own. An empty table gives
    an empty one.

    Best fit decreasing in bulk-synchronous supersteps. Pieces and gaps are ranked among those of their size; then,
    phase by phase of falling length, a sweep matches all waiting pieces with gaps, the gaps are updated,
    and so on as long as a gap holds a piece that waits and enough find one; of what is left, each length fills whole new
    sequences, and for the few over (less than a sequence of each length) as many empty ones are opened as
    they need at least, and they wait for the next phase. A superstep is one written table of pieces and gaps; the driver sees
    counts and extremes only. The result is written and all steps' tables are deleted."""
    pieces = pieces.drop("sequence_id", "offset")
    spark = pieces.sparkSession
    phase = lambda lo, hi: (F.col("length") > lo) & (F.col("length") <= hi)
    bounds = sorted({capacity // k for k in _PHASES if k <= capacity}, reverse=True)
    spans = list(zip(bounds, [*bounds[1:], 0], strict=True))
    in_phase = [F.coalesce(F.sum(F.when(phase(lo, hi), F.col("count"))), F.lit(0)) for hi, lo in spans]
    least, most, hot, *numbers = pieces.groupBy("length").count().agg(F.min("length"), F.max("length"), F.max("count"), *in_phase).first()
    if most is not None and not 0 < least <= most <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    ranked = pieces.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "piece"))
    ranked = written(running(ranked, ["length"], hash_bucket("_h", max(1, -(-(hot or 0) // per_bucket))), ["_h", "doc_id", "piece"], F.lit(1), "_rank").drop("_h"))
    gaps, waiting = (spark.range(0).select(F.col("id").alias(a), F.col("id").alias(b)) for a, b in (("sequence_id", "gap"), ("length", "rank")))
    first, states, opens, over = 0, [], [], 0
    alone = F.when(F.col("sequence_id").isNull(), F.col("length"))
    told = [F.count(alone), F.min(alone), F.sum(alone), F.max("sequence_id"), F.max("gap")]
    none = F.lit(None).cast("long")

    def opened(waiting: DataFrame, live: DataFrame) -> DataFrame:
        """What a sweep reads, always as one table of one form, so that all sweeps have one plan."""
        table = waiting.select("length", "rank", none.alias("sequence_id"), none.alias("gap")).union(live.select(none, none, "sequence_id", "gap"))
        opens.append(out := written(table))
        return out

    parts = lambda table: (table.where(F.col("sequence_id").isNull()).select("length", "rank"), table.where(F.col("gap") > 0).select("sequence_id", "gap"))
    for k, ((hi, lo), n) in enumerate(zip(spans, numbers, strict=True)):
        if not n + over:
            continue
        waiting = waiting.union(ranked.where(phase(lo, hi)).select("length", F.col("_rank").alias("rank"))) if n else waiting
        small, live = gaps.where((F.col("gap") <= lo) & (F.col("gap") >= least)), gaps.where(F.col("gap") > lo)
        last, sweep, left = not any(numbers[k + 1 :]), first > 0, n + over
        waiting, live = parts(opened(waiting, live))
        while left:
            before = left
            if sweep:
                classes = written(_classes(waiting, live, None, per_bucket))
                states.append(state := written(_swept(_matched(waiting, live, None, per_bucket, classes))))
                dropped(classes)
            else:
                states.append(state := written(_own(waiting, first, capacity)))
            left, shortest, tokens, number, widest = state.agg(*told).first()
            waiting, kept = parts(state)
            if sweep:
                live = kept
                few = not last and (before - left) * _FEW < before
            else:
                first = max(first, -1 if number is None else number + 1)
                more, few = -(-(tokens or 0) // capacity), False
                new = spark.range(first, first + more).select(F.col("id").alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"))
                first, widest = first + more, capacity
                live = live.union(kept).union(new)
                if left <= capacity and not last:
                    break
                if left:
                    waiting, live = parts(opened(waiting, live))
            # The next sweep moves something if any gap holds any piece that waits.
            sweep = bool(left) and not few and widest is not None and widest >= shortest
        over = left
        gaps = small.union(live)
    folders = sorted({f.rpartition("/")[0] for x in states for f in x.inputFiles()})
    every = spark.read.schema(states[0].schema).parquet(*folders) if folders else waiting.select("length", "rank", F.lit(0).cast("long").alias("sequence_id"))
    placed = every.where(F.col("length").isNotNull() & F.col("sequence_id").isNotNull())
    upto = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select("length", F.col("rank").alias("_rank"), "sequence_id", F.coalesce(F.sum("length").over(upto), F.lit(0)).alias("offset"))
    out = written(ranked.join(placed, ["length", "_rank"]).select(*pieces.columns, "sequence_id", "offset"))
    dropped(ranked, *states, *opens)
    return out


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """Tokenizes `docs` and packs the pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(tokenized(docs, path, capacity, end))
    packed = best_fit(pieces, capacity)
    dropped(pieces)
    return packed
