"""SimHash document fingerprints, and permuted block tables that find those within a Hamming radius.
DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

BITS = 128
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def fingerprints(texts: DataFrame, key: list[str], text: str = "text", shingle: int = 5) -> DataFrame:
    """`key`, hi, lo (two longs of 64 bits) for each key of `texts`.

    Terms are runs of `shingle` words (a shorter text is one term), weighted by how often they occur:
    each occurrence votes, for each bit of the term's 128-bit hash, for one if it is set and else for
    zero. Ties give zero. A null or blank text has no terms and the fingerprint 0; equal texts have
    equal fingerprints, as have rows that share a key and a text.

    The votes are summed where the text is, two bits in each long, so one row a text is shuffled."""
    words = texts.select(*key, F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "").alias("_w"))
    at = F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.greatest(F.size("_w") - shingle, F.lit(0))))
    terms = words.select(*key, "_w", F.explode_outer(at).alias("_i"))
    terms = terms.select(*key, F.when(F.col("_i").isNotNull(), F.xxhash64(*[F.get("_w", F.col("_i") + k) for k in range(shingle)])).alias("_a"))
    terms = terms.withColumn("_b", F.when(F.col("_a").isNotNull(), F.xxhash64(F.lit(1), "_a")))
    votes = {f"_{c}{k}": F.sum(F.shiftrightunsigned(f"_{c}", k).bitwiseAND(F.lit(_LANES))) for c in "ab" for k in range(32)}
    summed = terms.groupBy(*key).agg(F.count("_a").alias("_n"), *[v.alias(c) for c, v in votes.items()])

    def packed(c: str) -> Column:
        bits = [F.when(F.coalesce(x, F.lit(0)) * 2 > F.col("_n"), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")) for x in [*[F.col(f"_{c}{k}").bitwiseAND(F.lit(_LOW)) for k in range(32)], *[F.shiftrightunsigned(f"_{c}{k}", 32) for k in range(32)]]]
        out = bits[0]
        for k in range(1, 64):
            out = out.bitwiseOR(F.shiftleft(bits[k], k))
        return out

    return summed.select(*key, packed("a").alias("hi"), packed("b").alias("lo"))


def shown(hi: str = "hi", lo: str = "lo") -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi1: str, lo1: str, hi2: str, lo2: str) -> Column:
    return F.bit_count(F.col(hi1).bitwiseXOR(F.col(hi2))) + F.bit_count(F.col(lo1).bitwiseXOR(F.col(lo2)))


def _block(k: int, cuts: list[int], hi: Column, lo: Column) -> list[Column]:
    """The bits of block `k`, in one or two longs."""
    parts = []
    for word, base in ((hi, 0), (lo, 64)):
        a, b = max(cuts[k], base) - base, min(cuts[k + 1], base + 64) - base
        if a < b:
            parts.append(F.shiftrightunsigned(F.shiftleft(word, a), 64 - b + a))
    return parts


def _pairs(queries: DataFrame, index: DataFrame, radius: int, blocks: int | None) -> DataFrame:
    """q_hi, q_lo, distance and the columns of `index`, for `queries` and `index` of distinct hi, lo."""
    blocks = blocks or radius + 2
    if not 0 <= radius < blocks <= 32:
        raise ValueError("radius < blocks <= 32")
    cuts = [round(k * BITS / blocks) for k in range(blocks + 1)]
    tables = list(combinations(range(blocks), blocks - radius))
    keys = F.array(*[F.xxhash64(F.lit(i), *[p for k in t for p in _block(k, cuts, F.col("hi"), F.col("lo"))]) for i, t in enumerate(tables)])
    masks = F.array(*[F.struct(F.lit(sum(1 << k for k in t)).cast("long").alias("own"), F.lit((2 << t[-1]) - 1).cast("long").alias("upto")) for t in tables])
    q = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"), F.explode(F.arrays_zip(keys.alias("k"), masks.alias("m"))).alias("_q"))
    q = q.select("q_hi", "q_lo", F.col("_q.k").alias("_k"), F.col("_q.m").alias("_m"))
    met = q.join(index.select("*", F.explode(keys).alias("_k")), "_k").withColumn("distance", distance("q_hi", "q_lo", "hi", "lo").cast("int"))
    differ = [_block(k, cuts, F.col("hi").bitwiseXOR(F.col("q_hi")), F.col("lo").bitwiseXOR(F.col("q_lo"))) for k in range(blocks)]
    agreed = F.lit(0).cast("long")
    for k, words in enumerate(differ):
        agreed = agreed.bitwiseOR(F.when(reduce(Column.bitwiseOR, words) == 0, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    first = agreed.bitwiseAND(F.col("_m.upto")) == F.col("_m.own")
    return met.where((F.col("distance") <= radius) & first).drop("_k", "_m")


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """q_hi, q_lo, hi, lo, distance: the distinct fingerprints of `index` (hi, lo) within `radius` of
    the distinct ones of `queries`; join either side back for its rows, of which equal ones need no
    pairs. None is missed: the 128 bits are cut into `blocks` (radius + 2 if not given), a pair within
    the radius agrees on at least blocks - radius of them, and there is a table for each choice of so
    many blocks, permuted to the front as its key. A pair is kept by the first table that has it."""
    found = _pairs(queries.select("hi", "lo").distinct(), index.select("hi", "lo").distinct(), radius, blocks)
    return found.select("q_hi", "q_lo", "hi", "lo", "distance")


def neighbours(asked: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """hi, lo, n_within for the distinct fingerprints of `asked`: how many other rows of `prints` have one within
    `radius`. Copies are counted by their fingerprint, not paired. Both sides are written first, so that the
    tables are made of small rows alone and the side that asks is known to be small where it is."""
    copies = written(prints.groupBy("hi", "lo").agg(F.count("*").alias("n")))
    asked = written(asked.select("hi", "lo").distinct())
    hits = _pairs(asked, copies, radius, None)
    return hits.groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg((F.sum("n") - 1).alias("n_within"))


def _below(cuts: list[int], strictly: bool) -> Column:
    """How many of the sorted `cuts` are less than doc_id (or, if not `strictly`, equal to it), by halving."""
    known = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    holds = (lambda x: x < F.col("doc_id")) if strictly else (lambda x: x <= F.col("doc_id"))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(holds(F.get(known, at + step - 1)), step).otherwise(0))


def in_order(docs: DataFrame, per_bucket: int = 1000, most: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """`docs` (doc_id, text) with bucket, rn, next_text, and the table (bucket, next_bucket).

    Buckets lie between quantiles of doc_id, so each has about as many rows (`per_bucket`, or more where that
    took over `most` buckets), however the ids are spread; an id that several quantiles fall on has its rows
    dealt out to the buckets there by a hash of the text. The next document is a window away within a bucket,
    where the first row of the next bucket that has any (after the last: of the first) is a guest at the end.
    Equal ids go by bucket and that hash. A null doc_id comes before all others, in buckets of its own."""
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    buckets, own = min(most, -(-(n - nulls) // per_bucket)), max(1, min(most, -(-nulls // per_bucket)))
    cuts: list[int] = []
    if buckets > 1:
        shares = ",".join(str(k / buckets) for k in range(1, buckets))
        cuts = docs.agg(F.expr(f"percentile_approx(doc_id, cast(split('{shares}', ',') as array<double>), {16 * buckets})")).first()[0]
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    part = lambda k: F.shiftright(F.shiftrightunsigned("_h", 33) * k, 31)  # noqa: E731  the hashes in k ranges
    below, hot = (_below(cuts, True), _below(cuts, False) - _below(cuts, True)) if cuts else (F.lit(0), F.lit(0))
    docs = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), part(F.lit(own)) - own).when(hot == 0, below).otherwise(below + part(hot + 1)).cast("long"))
    firsts = docs.groupBy("bucket").agg(F.min(F.struct("doc_id", "_h")).alias("_first"))
    after = Window.orderBy("bucket")
    firsts = firsts.withColumns({"next_bucket": F.lead("bucket").over(after), "_next": F.lead("_first").over(after)})
    start = Window.partitionBy().orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.withColumns({"next_bucket": F.coalesce("next_bucket", F.first("bucket").over(start)), "_next": F.coalesce("_next", F.first("_first").over(start))})
    firsts = written(firsts.select("bucket", "next_bucket", F.col("_next.doc_id").alias("_next_id"), F.col("_next._h").alias("_next_h")))
    met = docs.join(firsts.select(F.col("bucket").alias("_at"), "_next_id", "_next_h"), F.col("doc_id").eqNullSafe(F.col("_next_id")) & (F.col("_h") == F.col("_next_h")))
    rows = docs.withColumn("_guest", F.lit(False)).unionByName(met.select("doc_id", "text", F.col("_at").alias("bucket"), "_h", F.lit(True).alias("_guest")))
    w = Window.partitionBy("bucket").orderBy("_guest", "doc_id", "_h")
    rows = rows.withColumns({"rn": F.row_number().over(w), "next_text": F.lead("text").over(w)}).where(~F.col("_guest"))
    rows = rows.select("doc_id", "text", "bucket", "rn", "next_text")
    return rows, firsts.select("bucket", "next_bucket")


def edited(docs: DataFrame, radius: int = 3) -> DataFrame:
    """For each row of `docs` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint and
    edited_fingerprint of the text and of the text whose last half is replaced by the start of the next
    document, near_edited and near_next: the share of equal bits with the edited text's fingerprint and
    the next document's; for ids divisible by 100 n_within, the number of other rows with a fingerprint within
    `radius` (else null). A lone document is its own next. Null texts count as empty. Repeated rows
    give a row each. An empty table gives an empty one."""
    rows, order = in_order(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    key = ["bucket", "rn", "doc_id", "n_chars", "sha"]
    rows = rows.select("bucket", "rn", "doc_id", F.length("text").cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("sha"), F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    prints = fingerprints(rows, [*key, "kind"])
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    prints = prints.groupBy(*key).agg(of(0, "hi").alias("hi"), of(0, "lo").alias("lo"), of(1, "hi").alias("e_hi"), of(1, "lo").alias("e_lo"))
    prints = written(prints)
    w = Window.partitionBy("bucket").orderBy("rn")
    prints = prints.withColumns({"_hi": F.lead("hi").over(w), "_lo": F.lead("lo").over(w)})
    met = order.join(prints.where(F.col("rn") == 1).select(F.col("bucket").alias("next_bucket"), F.col("hi").alias("m_hi"), F.col("lo").alias("m_lo")), "next_bucket")
    prints = prints.join(met.drop("next_bucket"), "bucket").withColumns({"_hi": F.coalesce("_hi", "m_hi"), "_lo": F.coalesce("_lo", "m_lo")})
    near = lambda a, b: 1 - distance("hi", "lo", a, b) / F.lit(float(BITS))
    prints = written(prints.select("hi", "lo", "doc_id", "n_chars", "sha", "e_hi", "e_lo", near("e_hi", "e_lo").alias("near_edited"), near("_hi", "_lo").alias("near_next")))
    asked = F.col("doc_id") % 100 == 0
    found = written(neighbours(prints.where(asked), prints, radius))
    rest = prints.where(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("long"))
    prints = prints.where(asked).join(found, ["hi", "lo"]).unionByName(rest)
    return prints.select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), shown().alias("fingerprint"), shown("e_hi", "e_lo").alias("edited_fingerprint"), "near_edited", "near_next", "n_within")
