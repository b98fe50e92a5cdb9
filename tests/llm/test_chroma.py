import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import chroma

SOUND = chroma.Sound(rate=8000, frame=1024, hop=128)


def tune(seed, seconds=4.0):
    rng = np.random.default_rng(seed)
    notes = 110 * 2 ** (rng.integers(0, 36, int(seconds * 8)) / 12)
    t = np.arange(1000) / 8000
    wave = np.concatenate([np.sin(2 * np.pi * f * t) for f in notes])
    return (wave * 12000).astype("<i2").tobytes()


def brute_codes(image):
    def area(t0, t1, p0, p1):
        return image[t0:t1, p0:p1].astype(float).sum()

    out = []
    for t in range(len(image) - chroma.WIDEST + 1):
        code = 0
        for kind, p, h, w in chroma._filters():
            whole, q = area(t, t + w, p, p + h), p + h
            a = [whole, area(t, t + w, p + h // 2, q), area(t + w // 2, t + w, p, q), area(t, t + w // 2, p, p + h // 2) + area(t + w // 2, t + w, p + h // 2, q), area(t, t + w, p + h // 3, q - h // 3), area(t + w // 3, t + w - w // 3, p, q)][kind]
            b = area(t, t + w, 0, 12) - whole if kind == 0 and h < 12 else area(t, t + w, 0, 6) if kind == 0 else whole - a
            ratio = np.log((1 + a) / (1 + max(b, 0)))
            level = int(ratio > -0.15) + int(ratio > 0) + int(ratio > 0.15)
            code = code << 2 | (level ^ level >> 1)
        out.append(code)
    return np.array(out, np.uint32)


def test_codes_are_those_of_summed_areas():
    image = np.random.default_rng(3).random((40, 12)).astype(np.float32)
    assert (chroma.codes(image) == brute_codes(image)).mean() > 0.99


def test_votes_are_counts_of_equal_codes():
    rng = np.random.default_rng(5)
    for span in (3, 40):
        a, b = (rng.integers(0, span, n).astype(np.uint32) for n in (70, 50))
        want = np.zeros(119)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                want[i - j + 49] += x == y
        assert (chroma.offset_votes(a, b) == want).all()
    still = np.zeros(600, np.uint32)
    assert chroma.offset_votes(still, still).max() == 600 and chroma.offset_votes(still, still).sum() == 360_000


def test_a_noisy_excerpt_is_found():
    whole = tune(1)
    part = np.frombuffer(whole, "<i2")[37 * 128 :].astype(float)
    part = (part * 0.7 + np.random.default_rng(2).normal(0, 200, len(part))).astype("<i2").tobytes()
    offset, votes, wrong = chroma.align(chroma.fingerprint(whole, SOUND), chroma.fingerprint(part, SOUND))
    assert offset == 37 and votes > 50 and wrong < 0.1
    other = chroma.align(chroma.fingerprint(whole, SOUND), chroma.fingerprint(tune(9), SOUND))
    assert other[1] < votes / 3 and other[2] > 1.5 * wrong


def test_edges(spark):
    rows = [(1, None), (2, b""), (3, b"\0" * 9), (4, bytes(60000)), (5, tune(1)), (5, tune(1)), (6, tune(2)), (None, tune(2))]
    df = spark.createDataFrame(rows, "doc_id long, data binary")
    got = chroma.excerpts(df, SOUND).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert all(by[k].n_codes == 0 and by[k].offset is None and by[k].class_id == k for k in (1, 2, 3))
    assert by[5].offset == by[5].cut and by[5].class_id == 5 and by[6].class_id == 6 and by[None].class_id == 6
    assert chroma.excerpts(df.limit(0), SOUND).count() == 0
    kept = chroma.fingerprints(df.withColumn("codes", F.lit("clash")), SOUND)
    assert dict(kept.dtypes)["codes"] == "array<bigint>"
    pairs = kept.alias("x").join(kept.alias("y"), F.col("x.doc_id") == F.col("y.doc_id")).select("x.doc_id", F.col("x.codes").alias("a"), F.col("y.codes").alias("b"))
    assert {r.offset for r in chroma.aligned(pairs.where("doc_id in (5, 6)")).collect()} == {0}


def test_votes_in_some_places_at_a_time(monkeypatch):
    """Codes that are common, rare, hot and missing, with few pairs counted at a time; and few calls for many codes."""
    monkeypatch.setattr(chroma, "_PAIRS", 7)
    rng = np.random.default_rng(6)
    a, b = (np.concatenate([rng.integers(0, 30, n), np.full(400, 99), rng.integers(200 + n, 230 + n, 9)]).astype(np.uint32) for n in (60, 80))
    want = np.zeros(len(a) + len(b) - 1)
    np.add.at(want, (np.arange(len(a))[:, None] - np.arange(len(b)) + len(b) - 1)[a[:, None] == b], 1)
    assert (chroma.offset_votes(a, b) == want).all()
    calls, real = [], np.flatnonzero
    monkeypatch.setattr(chroma, "_PAIRS", 1 << 20)
    monkeypatch.setattr(np, "flatnonzero", lambda x: calls.append(1) or real(x))
    many = np.arange(3000, dtype=np.uint32)
    assert chroma.offset_votes(many, many)[2999] == 3000 and len(calls) < 10
