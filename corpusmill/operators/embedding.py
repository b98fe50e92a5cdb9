"""Embedding through a pluggable provider. The default one hashes words: no model is installed here."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.resilience import RateLimiter, with_retries
from .chunking import token_batches
from .tables import dropped, written

Provider = Callable[[list[str]], np.ndarray]


def hashing(dimension: int = 384) -> Callable[[], Provider]:
    """A stand-in for a model: words and pairs of words add signs at hashed places; rows have length 1, but
    a text without words is 0."""

    def make() -> Provider:
        def embed(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimension), np.float32)
            for row, text in zip(out, texts, strict=True):
                words = text.lower().split()
                terms = [*words, *map(" ".join, zip(words[:-1], words[1:], strict=True))]
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
                row += np.bincount((h % dimension).astype(np.intp), np.where(h >> 63, 1.0, -1.0), dimension)
            return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

        return embed

    return make


def embedded(chunks: DataFrame, provider: Callable[[], Provider] | None = None, dimension: int = 384, batch: int = 64, requests: float | None = None) -> DataFrame:
    """Adds `embedding` (array<float>) to `chunks` (text, others). `provider` makes the model once a task. A batch
    that fails goes on one by one, and a text that fails alone gets zeros. `requests` a minute, if given, are
    what one task may make. Persist or write the result before using it twice."""
    provider = provider or hashing(dimension)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, limiter = provider(), RateLimiter(requests, 1e12) if requests else None

        def call(texts: list[str]) -> np.ndarray:
            if limiter:
                limiter.acquire()
            return with_retries(lambda: model(texts))

        def single(text: str) -> np.ndarray:
            try:
                return call([text])[0]
            except Exception:
                return np.zeros(dimension, np.float32)

        for frame in batches:
            texts = [(t or "").replace("\0", "").strip() or " " for t in frame["text"]]
            out: list[np.ndarray] = []
            for at in range(0, len(texts), batch):
                try:
                    out += list(call(texts[at : at + batch]))
                except Exception:
                    out += [single(t) for t in texts[at : at + batch]]
            yield frame.assign(embedding=[np.asarray(v, np.float32) for v in out])

    chunks = chunks.drop("embedding")
    return chunks.mapInPandas(run, chunks.withColumn("embedding", F.array().cast("array<float>")).schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


#: Calls that a worker announces in a round, at most, and tokens with which a round is full.
_AHEAD, _AHEAD_TOKENS = 256, 1 << 21


def in_rounds(mine: Iterator[tuple[int, Callable[[], object]]], gather: Callable[[str], list[str]], place: int, limiter: RateLimiter) -> Iterator[object]:
    """What the calls of `mine` (tokens, call) return, in order. In each round all workers tell the calls that they are about to make; each acquires the
    tokens of all, the first call of each worker, then the second of each, and makes a call when its own turn has come. So all keep the
    same account of one rate, whoever has more left to do, and go on until nobody has. A round is many calls, as workers meet but about once
    a second."""
    while True:
        ahead, size = [], 0
        while len(ahead) < _AHEAD and size < _AHEAD_TOKENS and (item := next(mine, None)) is not None:
            ahead.append(item)
            size += item[0]
        told = [json.loads(x) for x in gather(json.dumps([tokens for tokens, _ in ahead]))]
        if not any(told):
            return
        for turn in range(max(map(len, told))):
            for k, tokens in enumerate(told):
                if turn < len(tokens):
                    limiter.acquire(tokens[turn])
                    if k == place:
                        yield ahead[turn][1]()


def embedded_by_budget(chunks: DataFrame, order: list[str], tokens: str, provider: Callable[[], Provider] | None = None, dimension: int = 384, max_tokens: int = 8000, max_items: int = 2048, rate: float = 900_000, requests: float = 3000, workers: int | None = None) -> DataFrame:
    """Adds batch and `embedding` (array<float>) to `chunks` (text, `tokens`, others), written: the provider gets the batches of `token_batches` in
    the order of `order`, one request each, and all `workers` (barrier tasks, by default one for each core) together make no more than
    `rate` tokens and `requests` a minute. A vector stays with its row. A batch that fails goes on one by one, and a text that fails alone
    gets zeros; a text with more tokens than ten seconds of the rate is an error. If a worker is lost, all begin anew."""
    provider = provider or hashing(dimension)
    workers = workers or chunks.sparkSession.sparkContext.defaultParallelism
    rows = token_batches(chunks.drop("embedding", "batch"), [], order, tokens, max_tokens, max_items)
    schema = rows.withColumn("embedding", F.array().cast("array<float>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, model = BarrierTaskContext.get(), provider()

        def vectors(texts: list[str]) -> np.ndarray:
            try:
                return with_retries(lambda: model(texts))
            except Exception:
                if len(texts) == 1:
                    return np.zeros((1, dimension), np.float32)
                return np.concatenate([vectors([t]) for t in texts])

        def call(part: list[dict]) -> Callable[[], list[dict]]:
            texts = [(r["text"] or "").replace("\0", "").strip() or " " for r in part]
            return lambda: [{**r, "embedding": v.tolist()} for r, v in zip(part, np.asarray(vectors(texts), np.float32), strict=True)]

        parts = (list(p) for _, p in groupby(_rows(batches), lambda r: r["batch"]))
        mine = ((sum(r[tokens] or 0 for r in p), call(p)) for p in parts)
        limiter = RateLimiter(requests, rate, time.monotonic, time.sleep)
        for found in in_rounds(mine, context.allGather, context.partitionId(), limiter):
            yield pa.RecordBatch.from_pylist(found, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    dealt = rows.repartition(workers, "batch").sortWithinPartitions("batch", *order)
    out = written(dealt.mapInArrow(run, schema, barrier=True))
    dropped(rows)
    return out
