import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import simhash
from corpusmill.llm.common import written

from .conftest import prose


def brute(spark, text, size=5):
    """The votes, from Spark's hash of each term."""
    words = [w for w in (text or "").replace("\n", " ").split(" ") if w]
    terms = [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    bits = [0] * 128
    for term, n in Counter(terms).items():
        a, b = spark.range(1).select(F.xxhash64(*map(F.lit, term)).alias("a")).select("a", F.xxhash64(F.lit(1), "a").alias("b")).first()
        for word, base in ((a, 0), (b, 64)):
            for k in range(64):
                bits[base + k] += n if word >> k & 1 else -n
    return f"{sum((bits[k] > 0) << k for k in range(64)):016x}{sum((bits[64 + k] > 0) << k for k in range(64)):016x}"


def test_fingerprints_are_signed_votes(spark, make):
    texts = ["one two three four five six seven", "a b", None, "", "  ", "x " * 30, prose(1, 40)]
    rows = simhash.fingerprints(make(texts), ["doc_id"]).select("doc_id", simhash.shown().alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {i: brute(spark, t) for i, t in enumerate(texts)}


def test_edited(spark, make):
    texts = [prose(k, 60) for k in range(30)] + [None, "", "é", prose(3, 60), "tail\n"]
    docs = make(texts, first=5).union(make([texts[3]], first=8))  # a repeated row
    order = sorted([(r.doc_id, r.text or "") for r in docs.collect()])
    got = simhash.edited(docs.withColumn("bucket", F.lit("clash"))).collect()
    want = []
    for i, (k, t) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(t) // 2
        want.append((k, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[5 + 3] == prints[5 + 33] and all(0 <= r.near_next <= 1 for r in got)
    halves = [r for r in got if r.n_chars > 100]
    assert sum(r.near_edited for r in halves) / len(halves) > sum(r.near_next for r in halves) / len(halves) + 0.1
    assert simhash.edited(docs.limit(0)).count() == 0
    lone = simhash.edited(make(["abcd"])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and lone.near_next == 1.0


def test_neighbours(make):
    docs = make([prose(1, 300), *[prose(1, 300)] * 3, prose(1, 300) + " more", *[prose(k, 50) for k in range(2, 6)]], first=100)
    prints = written(simhash.fingerprints(docs, ["doc_id"]))
    rows = simhash.neighbours(prints.where("doc_id % 100 = 0"), prints, radius=20).collect()
    assert [r.n_within for r in rows] == [4]


def test_edited_counts_neighbours(make):
    docs = make([prose(1, 300), *[prose(1, 300)] * 3, prose(1, 300) + " more", *[prose(k, 50) for k in range(2, 6)]], first=100)
    docs = docs.union(make([None, ""], first=200)).union(docs.where("doc_id = 100"))
    got = [(r.doc_id, r.n_within) for r in simhash.edited(docs, radius=5).collect() if r.n_within is not None]
    prints = [(r.doc_id, int(r.f, 16)) for r in simhash.fingerprints(docs.withColumn("at", F.monotonically_increasing_id()), ["doc_id", "at"]).select("doc_id", simhash.shown().alias("f")).collect()]
    want = [(k, sum((f ^ g).bit_count() <= 5 for _, g in prints) - 1) for k, f in prints if k % 100 == 0]
    assert sorted(got) == sorted(want) and max(n for _, n in got) >= 4


def test_buckets(make):
    docs = make([f"t{k}" for k in range(50)])
    rows, _ = simhash.in_order(docs, per_bucket=7)
    assert {r.doc_id: r.next_text for r in rows.collect()} == {k: f"t{(k + 1) % 50}" for k in range(50)}


IDS = {
    "both ends of a long": [-(2**63), -(2**62) - 5, *range(-20, 20), 2**62 + 5, 2**63 - 1],
    "an outlier": [*range(200), 2**60],
    "all equal": [7] * 150,
    "a hot one": [*range(60), *[30] * 90, *range(60, 90)],
    "nulls": [*range(60), *[None] * 60],
}


@pytest.mark.parametrize("name", IDS)
def test_buckets_of_any_ids(make, spark, name):
    ids = IDS[name]
    docs = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(ids)], "doc_id long, text string")
    rows = simhash.in_order(docs, per_bucket=10)[0].collect()
    assert sorted(r.text for r in rows) == sorted(f"t{i}" for i in range(len(ids)))
    after, where = {r.text: r.next_text for r in rows}, {r.text: r for r in rows}
    sizes = [n for n in Counter(r.bucket for r in rows).values()]
    assert max(sizes) <= 45
    order = sorted(rows, key=lambda r: (r.bucket, r.rn))
    key = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert key == sorted(key)
    assert all(after[a.text] == b.text for a, b in zip(order, order[1:] + order[:1], strict=True)) and len(where) == len(ids)


def test_edited_of_ids_at_the_ends(make, spark):
    docs = spark.createDataFrame([(k, prose(i, 20)) for i, k in enumerate(IDS["both ends of a long"])], "doc_id long, text string")
    assert simhash.edited(docs).count() == len(IDS["both ends of a long"])


def test_no_pair_within_the_radius_is_missed(spark):
    import random

    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(20)]
    near = [b ^ sum(1 << k for k in rng.sample(range(128), n)) for b in base for n in (0, 1, 2, 3, 4, 5)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    to = lambda xs: written(spark.createDataFrame([(signed(x >> 64), signed(x & (1 << 64) - 1)) for x in xs], "hi long, lo long"))
    for radius in (0, 3):
        got = {(r.q_hi, r.q_lo, r.hi, r.lo): r.distance for r in simhash.within_radius(to(base), to(near), radius).collect()}
        want = {(signed(a >> 64), signed(a & (1 << 64) - 1), signed(b >> 64), signed(b & (1 << 64) - 1)): (a ^ b).bit_count() for a in base for b in near if (a ^ b).bit_count() <= radius}
        assert got == want
