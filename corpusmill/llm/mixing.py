"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, hash_bucket, hottest, running, written

#: Cells of the circle of slots by which slots find their sources, at least.
_CELLS = 1024


@dataclass(frozen=True)
class Mix:
    """`documents`: the rows, with uid, source_no, size. `sources`: source, source_no, source_size,
    target. `slots`: slot, source_no, block. `pieces`: source_no, block, uid, words, epoch. The mix is
    `slots` in order, each with the pieces of its block."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """A row for each source of `sizes` (source, source_size) with source_no and target.

    Sources by code point, null last, take `weights` in turn and share `share` times all sizes. None
    gets above `cap` times its size; what is left goes to the others by weight. In the order of size
    over weight, the sources up to some place are those at their cap, so running sums give the level
    that the rest share. One row for each source is all that meets in one window."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("source_no", F.row_number().over(by_name))
    s = s.withColumns({"_w": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") - 1) % len(weights) + 1), "_cap": F.col("source_size") * F.lit(float(cap))})
    whole = Window.partitionBy()
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), "source_no")
    s = s.withColumns({"_all": F.sum("source_size").over(whole) * F.lit(float(share)), "_full": F.coalesce(F.sum("_cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "_left": F.sum("_w").over(rising.rowsBetween(0, Window.unboundedFollowing))})
    s = s.withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_left"))
    s = s.withColumn("_level", F.max(F.when(F.col("_cap") >= F.col("_level") * F.col("_w"), F.col("_level"))).over(whole))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return s.select("source", "source_no", "source_size", target.alias("target"))


def words_wanted() -> Column:
    """The words that a source's target asks for."""
    return F.round("target").cast("long")


def golden_step(n: int) -> int:
    """The number nearest to n / golden ratio that shares no factor with n."""
    g = max(1, round(n * (sqrt(5) - 1) / 2))
    return next(x for k in range(n + 2) for x in (g - k, g + k) if x > 0 and gcd(x, n) == 1)


def golden_points(t: Column, n: int) -> Column:
    """t * golden ratio on a circle of n places: of t = 0 to n - 1 each place has one. Where products would
    not fit in a long, they are decimals."""
    step = golden_step(n)
    if n < 2**31:
        return t * F.lit(step) % F.lit(n)
    return (t.cast("decimal(19,0)") * F.lit(step).cast("decimal(19,0)") % F.lit(n).cast("decimal(19,0)")).cast("long")


def schedule(sources: DataFrame, block: int, per_bucket: int = 2_000) -> DataFrame:
    """Slots 0, 1, ...: slot, source_no, block. A source of `sources` (source_no, target) needs as many slots as
    blocks of `block` words begin in its target. The circle has a place for each slot and its arcs are the
    sources' needs, end to end; slot t belongs to the source whose arc holds the point t * golden ratio and
    is numbered within its source. Each place is hit once, so each source, however small, has just the slots
    that it needs, and any run of slots holds each source in nearly its share. Sources are found by cells of
    the circle: an equality join."""
    spark = sources.sparkSession
    needs = sources.select("source_no", F.ceil(words_wanted() / F.lit(block)).alias("_need")).where(F.col("_need") > 0)
    n, many = needs.agg(F.coalesce(F.sum("_need"), F.lit(0)), F.count("*")).first()
    cells = max(1, min(n, max(_CELLS, 2 * many)))
    width = max(1, -(-n // cells))
    upto = F.sum("_need").over(Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0))
    arcs = needs.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_need"))
    cell = lambda c: F.floor(c / F.lit(width))
    arcs = arcs.select("source_no", "_from", "_to", F.explode(F.sequence(cell(F.col("_from")), cell(F.col("_to") - 1))).alias("_cell"))
    slots = spark.range(n).select(F.col("id").alias("slot"), golden_points(F.col("id"), max(n, 1)).alias("_p")).withColumn("_cell", cell(F.col("_p")))
    slots = slots.join(arcs, "_cell").where((F.col("_p") >= F.col("_from")) & (F.col("_p") < F.col("_to"))).select("slot", "source_no")
    return running(slots, ["source_no"], F.floor(F.col("slot") / per_bucket), ["slot"], F.lit(1), "block")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, block: int = 64, seed: int = 17, per_bucket: int = 2_000, keep_text: bool = False) -> Mix:
    """Mixes `docs` (doc_id, source, text and any others): each source's documents are shuffled once
    for each epoch, joined end to end, ended at the source's target and cut into blocks of `block` words, of
    which the last may be shorter; the slots of the schedule take a source's blocks in turn, so each source
    gives its target, rounded to a word. No document is used more than `epochs` times.

    Null and empty texts have no words and take part in nothing; repeated rows count each; a null
    source is a source. An empty table gives empty tables. The shuffle hangs on values and `seed`
    alone, so reruns agree. Columns of the names that `documents` adds are replaced. `keep_text` keeps the texts in `documents`, for `mixed_documents`."""
    names = [c for c in docs.columns if c not in ("uid", "source_no", "source_size", "target", "size", "taken") and (keep_text or c != "text")]
    docs = docs.select(*names, word_count().alias("size"), F.monotonically_increasing_id().alias("uid"))
    docs = written(docs)
    sources = written(targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, epochs))
    docs = docs.withColumnRenamed("source", "_mix_source").join(sources, F.col("_mix_source").eqNullSafe(F.col("source"))).drop("_mix_source")
    stream = docs.where(F.col("size") > 0).select("uid", "doc_id", "source_no", "source_size", "size", words_wanted().alias("_end"), F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    stream = stream.withColumn("_h", F.xxhash64(F.lit(seed), "epoch", "doc_id", "size"))
    buckets = max(1, -(-hottest(docs, ["source_no"]) // per_bucket))
    stream = running(stream, ["source_no", "epoch"], hash_bucket("_h", buckets), ["_h", "doc_id", "uid"], "size", "_from")
    first = F.col("_from") + F.col("epoch") * F.col("source_size")
    stream = stream.where(first < F.col("_end")).select("uid", "source_no", "epoch", first.alias("_from"), F.least(first + F.col("size"), "_end").alias("_to"))
    pieces = stream.withColumn("block", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))))
    words = F.least("_to", (F.col("block") + 1) * block) - F.greatest("_from", F.col("block") * block)
    return Mix(docs, sources, schedule(sources, block, per_bucket), pieces.select("source_no", "block", "uid", words.alias("words"), "epoch"))


def taken(mixed: Mix) -> DataFrame:
    """`documents` of the mix with `taken`: the words that it takes of each row, repeats counted."""
    used = mixed.pieces.join(mixed.slots, ["source_no", "block"]).groupBy("uid").agg(F.sum("words").alias("taken"))
    return mixed.documents.join(used, "uid", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def mixed_documents(mixed: Mix, columns: list[str]) -> DataFrame:
    """The mix as documents of `columns`: a row for each document and epoch that has words in it (so up to
    `epochs` rows for a doc_id), in no order. A source's taken blocks are its stream's first, so a document
    is in whole or, where the stream stops within it, by its first words; n_chars follows the text."""
    used = mixed.pieces.join(mixed.slots, ["source_no", "block"]).groupBy("uid", "epoch").agg(F.sum("words").alias("taken"))
    rows = mixed.documents.join(used, "uid")
    head = F.array_join(F.slice(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), F.lit(1), F.col("taken").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("taken") < F.col("size"), head).otherwise(F.col("text")))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*columns)
