import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import packing
from corpusmill.llm.common import written

from .conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, World!", "it's we'LL 'sx ''", "tab\tand\nline  two", "ΣΑΣ Σας İstanbul", "a²b ½ x_*_y é'Re", "<|endoftext|> <|STARTOFTEXT|> <|x", "日本語 テスト 😀", "náive x\x1cy\x85z", prose(1, 3000), "longword" * 900]


def ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def test_pieces(make):
    rows = packing.tokenized(make(TEXTS), PATH).collect()
    for k, text in enumerate(TEXTS):
        want, mine = ids(text), sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in mine] == [(i, 2048 * i) for i in range(-(-len(want) // 2048))]
        assert [r.length for r in mine] == [len(want[r.start : r.start + 2048]) for r in mine]
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(np.array(want[r.start : r.start + 2048], "<u4").tobytes()) for r in mine]


def test_cache_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED_WORDS", 20)
    encode = packing._Encoder(PATH)
    for k in range(6):
        text = prose(k % 2, 40)
        assert encode([text])[0] == np.array(ids(text)[:-1], "<u4").tobytes()


def test_other_tokenizers_encode_whole_texts():
    for name in ("byte_bpe_50k.json",) if Path(public_tokenizers.path("byte_bpe_50k.json")).exists() else ():
        other = public_tokenizers.path(name)
        encode = packing._Encoder(other)
        assert not encode.by_word
        want = [Tokenizer.from_file(other).encode(t or "", add_special_tokens=False).ids for t in TEXTS]
        assert [np.frombuffer(x, "<u4").tolist() for x in encode([t or "" for t in TEXTS])] == want
    assert packing._Encoder(PATH).by_word


def sequential(lengths, capacity):
    """Best fit, one document after the other, from the longest on: the number of sequences."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - x)
    return len(gaps)


@pytest.mark.parametrize("case", ["mixed", "equal", "pairs"])
def test_best_fit(spark, case):
    rng = random.Random(3)
    lengths, capacity = {"mixed": ([rng.choice([rng.randint(1, 8), rng.randint(5, 30)]) for _ in range(150)], 30), "equal": ([7] * 90, 30), "pairs": ([rng.randint(40, 100) for _ in range(120)], 100)}[case]
    pieces = written(spark.createDataFrame([(i, 0, x) for i, x in enumerate(lengths)], "doc_id long, piece int, length long"))
    rows, bins = packing.best_fit(pieces, capacity, per_bucket=9).collect(), {}
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(lengths))
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == sequential(lengths, capacity)


def test_a_sweep_takes_the_smallest_gap_that_holds(spark):
    """Against brackets matched one by one."""
    rng = random.Random(5)
    gaps = [(k, rng.randint(1, 40)) for k in range(80)]
    lengths = [rng.randint(1, 25) for _ in range(90)]
    ranks = [(x, 5 + sum(y == x for y in lengths[:i])) for i, x in enumerate(lengths)]
    got = packing._matched(spark.createDataFrame(ranks, "length long, rank long"), spark.createDataFrame(gaps, "sequence_id long, gap long"), 40, 3).collect()
    size = dict(gaps)
    pairs = sorted((r.length, r.rank, size.get(r.sequence_id)) for r in got if r.length is not None)
    free, want = sorted(size.values()), []
    for x, rank in sorted(ranks, key=lambda p: (-p[0], p[1])):
        fit = next((g for g in free if g >= x), None)
        if fit is not None:
            free.remove(fit)
        want.append((x, rank, fit))
    assert pairs == sorted(want)
    used = [r.sequence_id for r in got if r.length is not None and r.sequence_id is not None]
    assert len(used) == len(set(used)) and sum(r.gap is not None for r in got) == len(gaps)


def test_pack(make):
    docs = make([prose(k, 30 + 11 * k) for k in range(120)] + ["same words"] * 60 + [None, ""]).withColumn("offset", F.lit("clash"))
    rows = packing.pack(docs.union(docs.where("doc_id = 3")), PATH).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= sum(r.length for r in rows) / 2048 * 1.02 + 1
    assert packing.pack(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.best_fit(make([""]).select("doc_id", F.lit(0).alias("piece"), F.lit(4000).cast("long").alias("length")))


def test_one_table_is_left(spark, make):
    from corpusmill.llm.common import shared_dir

    tables = lambda: set(Path(shared_dir(spark).removeprefix("file://")).glob("table-*"))
    before = tables()
    packed = packing.pack(make([prose(k, 40 + 9 * k) for k in range(60)]), PATH)
    assert len(tables() - before) == 1 and packed.count() >= 60


def test_pieces_that_wait_over_several_phases(spark):
    """Lengths that no gap of their phase holds wait for the next, with longer ones among them."""
    rng = random.Random(11)
    lengths = [rng.choice([1000, 690, 400, 41, 42, 3, 1]) for _ in range(300)] + [2048] * 3
    pieces = written(spark.createDataFrame([(i, 0, x) for i, x in enumerate(lengths)], "doc_id long, piece int, length long"))
    sums = packing.best_fit(pieces, per_bucket=7).groupBy("sequence_id").agg(F.sum("length").alias("s"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert sum(r.s for r in sums) == sum(lengths) and all(r.s == r.end <= 2048 for r in sums)
    assert len(sums) <= sequential(lengths, 2048) + 1


def test_sweeps_look_up_written_classes(spark, monkeypatch):
    """A sweep's classes are grouped once, not again for each of its joins: smaller plans in the driver."""
    pieces = spark.createDataFrame([(i, 0, 1 + i * 37 % 90) for i in range(60)], "doc_id long, piece int, length long")
    plans, write = [], packing.written
    monkeypatch.setattr(packing, "written", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df))
    sums = packing.best_fit(pieces, 100).groupBy("sequence_id").agg(F.sum("length").alias("s")).collect()
    assert max(r.s for r in sums) <= 100
    sweeps = [p for p in plans if "posexplode" in p]
    # One sum for each bucket is all that a sweep groups itself.
    assert sweeps and all(p.count("Aggregate [") == 1 for p in sweeps)
