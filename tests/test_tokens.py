"""Token counts, batches of whole groups, and embedding under one rate."""

import random
import threading

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import bpe
from corpusmill.functions.resilience import RateLimiter
from corpusmill.operators import chunking, embedding

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.ranks(PATH)
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_counts_on_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select("doc_id", "text", bpe.token_counter(spark, PATH, public_tokenizers.PATTERN)("text").alias("n")).collect()
    assert len(got) == 1000 and all(r.n == len(ORACLE.encode_ordinary(r.text or "")) for r in got)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_counts_on_any_text(s):
    s = s.encode("utf-8", "ignore").decode()
    assert bpe.Counter(RANKS, public_tokenizers.PATTERN)(s) == len(ORACLE.encode_ordinary(s))


@pytest.mark.parametrize("word", [b"a" * 3000, b"ab" * 999, "한국어".encode() * 50, b"<|endoftext|>", b""])
def test_ends_of_tokens(word):
    ends = bpe.merged(word, RANKS) if word else []
    pieces = [word[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(pieces) == word
    assert [RANKS[p] for p in pieces] == ORACLE._encode_single_piece(word) if word else not pieces


def test_no_vocabulary_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_TOKENS", 10)
    with pytest.raises(ValueError, match="more than 10"):
        bpe.ranks(PATH)


def greedy(tokens, max_tokens, max_items):
    out, batch, total, n = [], 0, 0, 0
    for t in tokens:
        if n and (total + t > max_tokens or n >= max_items):
            batch, total, n = batch + 1, 0, 0
        total, n = total + t, n + 1
        out.append(batch)
    return out


@pytest.mark.parametrize(("max_tokens", "max_items", "segment"), [(50, 4, 1), (50, 4, 2), (10, 3, 16), (1000, 2, 3), (0, 5, 2)])
def test_batches_over_many_segments(spark, monkeypatch, max_tokens, max_items, segment):
    """One group of nine rows in ten is cut into many segments, whose pointers are doubled several times."""
    monkeypatch.setattr(chunking, "_SEGMENT", segment)
    rng = random.Random(3)
    rows = [("hot" if k % 10 else rng.choice(["a", "b", None]), k, rng.choice([0, 1, 3, 20, 49, 50, 51, 400, None])) for k in range(300)]
    rng.shuffle(rows)
    got = chunking.token_batches(spark.createDataFrame(rows, "g string, k long, t long"), ["g"], ["k"], "t", max_tokens, max_items).collect()
    for g in ("hot", "a", "b", None):
        mine = sorted((r.k, r.t or 0, r.batch) for r in got if r.g == g)
        assert [b for _, _, b in mine] == greedy([t for _, t, _ in mine], max_tokens, max_items)
    assert len(got) == 300


def test_batches_of_no_and_of_equal_rows(spark):
    schema = "g string, k long, t long"
    assert chunking.token_batches(spark.createDataFrame([], schema), ["g"], ["k"], "t").count() == 0
    same = chunking.token_batches(spark.createDataFrame([("g", 1, 5)] * 10, schema), ["g"], ["k"], "t", 15, 8).collect()
    assert sorted(r.batch for r in same) == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


class Clock:
    def __init__(self):
        self.now = 0.0

    def sleep(self, s):
        self.now += s


def test_workers_keep_one_rate():
    """Three workers with unequal work: what all send never passes the rate, and each waits for its turn only."""
    work, sent, lock = [[500] * 9, [900] * 2, []], [], threading.Lock()
    barrier, told = threading.Barrier(3), [None] * 3

    def worker(place):
        clock = Clock()

        def gather(message):
            told[place] = message
            barrier.wait()
            out = list(told)
            barrier.wait()
            return out

        def call(n):
            with lock:
                sent.append((clock.now, n))
            return n

        mine = ((n, lambda n=n: call(n)) for n in work[place])
        limiter = RateLimiter(6000, 60_000, lambda: clock.now, clock.sleep)
        got = list(embedding.in_rounds(mine, gather, place, limiter))
        assert got == work[place]

    threads = [threading.Thread(target=worker, args=(k,)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    sent.sort()
    assert len(sent) == 11
    for at, _ in sent:  # 1000 tokens a second, with one second's budget at first
        assert sum(n for t, n in sent if t <= at) <= 1000 + 1000 * at + 1e-6
    assert sent[-1][0] == pytest.approx((sum(map(sum, work)) - 1000) / 1000, abs=0.01)


def test_workers_meet_once_for_many_calls():
    """A meeting of barrier tasks takes about a second, so a thousand calls must not take a thousand of them."""
    meetings, limiter = [], RateLimiter(6e9, 6e12)
    mine = ((10, lambda k=k: k) for k in range(1000))
    got = list(embedding.in_rounds(mine, lambda message: meetings.append(message) or [message], 0, limiter))
    assert got == list(range(1000)) and len(meetings) <= 6


def test_hashed_vectors_are_sums_of_signs():
    import xxhash

    texts = ["", "a", "b a  b a c", "한 Word " * 50]
    for text, got in zip(texts, embedding.hashing(16)()(texts), strict=True):
        words, want = text.lower().split(), np.zeros(16)
        for term in [*words, *map(" ".join, zip(words[:-1], words[1:]))]:
            h = xxhash.xxh3_64_intdigest(term)
            want[h % 16] += 1 if h >> 63 else -1
        assert got.dtype == np.float32 and np.allclose(got, want / max(np.linalg.norm(want), 1e-12))


def counting(dimension, most):
    def make():
        model = embedding.hashing(dimension)()

        def embed(texts):
            assert len(texts) <= most
            if "poison" in texts and len(texts) > 1:
                raise ValueError("all or nothing")
            return model(texts)

        return embed

    return make


def test_vectors_are_those_of_single_texts(spark):
    rng = random.Random(8)
    rows = [(k, None if k == 7 else "poison" if k == 9 else f"text {rng.randrange(50)} of {k}", rng.randrange(1, 90), {"a": k}) for k in range(60)]
    docs = spark.createDataFrame([*rows, rows[5]], "id long, text string, n long, extra map<string, int>")
    got = embedding.embedded_by_budget(docs, ["id"], "n", counting(16, 6), 16, max_tokens=200, max_items=6, rate=6e8, requests=6e6, workers=3).collect()
    model = embedding.hashing(16)()
    assert len(got) == 61
    for r in got:
        assert np.allclose(r.embedding, model([r.text or " "])[0]) and r.extra == {"a": r.id}
    by: dict = {}
    for r in got:
        by.setdefault(r.batch, []).append(r.n)
    assert all(len(v) <= 6 and (sum(v) <= 200 or len(v) == 1) for v in by.values())
    assert [r.batch for r in sorted(got, key=lambda r: (r.id, r.batch))] == greedy([r.n for r in sorted(got, key=lambda r: (r.id, r.batch))], 200, 6)


def test_no_rows_to_embed(spark):
    empty = spark.createDataFrame([], "id long, text string, n long")
    got = embedding.embedded_by_budget(empty, ["id"], "n", dimension=4, workers=2)
    assert got.columns == ["id", "text", "n", "batch", "embedding"] and got.count() == 0


def test_counted_tokens_bound_batches(spark):
    docs = spark.createDataFrame([(k, "hello world " * (k % 40)) for k in range(80)], "id long, text string")
    items = docs.withColumn("n", bpe.token_counter(spark, PATH, public_tokenizers.PATTERN)("text"))
    sums = chunking.token_batches(items, [], ["id"], "n", 300, 20).groupBy("batch").agg(F.sum("n").alias("s"), F.count("*").alias("c")).collect()
    assert all(r.s <= 300 and r.c <= 20 for r in sums) and len(sums) > 5


def test_texts_come_in_small_batches(spark):
    """A task holds a bounded number of rows, whatever the size of the table."""
    from pyspark.sql.functions import pandas_udf

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    bpe.token_counter(spark, PATH, public_tokenizers.PATTERN)

    @pandas_udf("long")
    def rows(x):
        return x * 0 + len(x)

    assert spark.range(9000).repartition(1).select(rows("id").alias("n")).agg(F.max("n")).first()[0] <= 1000


def test_tokens_are_counted_once(spark, sf_dir, monkeypatch):
    """A sort by range reads its input twice, so what is costly is written before it."""
    from corpusmill.plans import text_queries

    counted = spark.sparkContext.accumulator(0)

    def counter(_):
        @F.udf("long")
        def count(text):
            counted.add(1)
            return len(text or "")

        return count

    monkeypatch.setattr(text_queries, "_counter", counter)
    n = text_queries.token_batches_counted(spark, sf_dir).count()
    assert n == counted.value
