"""Tokens by byte-pair merging over a vocabulary of ranks, such as the public tokenizers publish."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import give_back, small_batches

#: The largest vocabulary that is sent to all tasks: 1,000,000 tokens are some 100 MB in a task.
MOST_TOKENS = 1_000_000
#: Words whose counts a task keeps.
_KEPT_WORDS = 200_000
#: In words of up to so many bytes the lowest rank is found by looking at all.
_SHORT = 32
#: Above every rank.
_NONE = 1 << 62


def ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file's tokens: on each line one in base 64, and its rank."""
    found = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())}
    if len(found) > MOST_TOKENS:
        raise ValueError(f"{path} has {len(found)} tokens, more than {MOST_TOKENS}")
    return found


def merged(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ends of the word's tokens. Of all neighbours the two whose union has the lowest rank are joined (of equals the first), until
    no union is a token. A heap has the pairs; what was joined since a pair went in makes it stale."""
    if word in rank:
        return [len(word)]
    n = len(word)
    if n <= _SHORT:
        ends, low = list(range(1, n + 1)), [rank.get(word[i : i + 2], _NONE) for i in range(n - 1)]
        while low and (least := min(low)) < _NONE:
            i = low.index(least)
            del ends[i], low[i]
            if i:
                low[i - 1] = rank.get(word[ends[i - 2] if i > 1 else 0 : ends[i]], _NONE)
            if i < len(low):
                low[i] = rank.get(word[ends[i - 1] if i else 0 : ends[i + 1]], _NONE)
        return ends
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a token begins at i and ends at after[i]
    heap = [(rank[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in rank]
    heapq.heapify(heap)
    alive = bytearray(b"\1") * n

    def offer(i: int) -> None:
        if after[i] < n and (r := rank.get(word[i : after[after[i]]])) is not None:
            heapq.heappush(heap, (r, i, after[after[i]]))

    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        alive[after[i]] = 0
        after[i] = end
        if end < n:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [after[i] for i in range(n) if alive[i]]


class Counter:
    """Counts tokens of texts; a word's count is kept while there is room."""

    def __init__(self, rank: dict[bytes, int], pattern: str):
        self.rank, self.words, self.kept = rank, regex.compile(pattern), {}

    def __call__(self, text: str | None) -> int:
        total = 0
        for word in self.words.findall(text or ""):
            n = self.kept.get(word)
            if n is None:
                n = len(merged(word.encode(), self.rank))
                if len(self.kept) >= _KEPT_WORDS:
                    self.kept.clear()
                self.kept[word] = n
            total += n
        return total


def token_counter(spark: SparkSession, path: str, pattern: str) -> Callable[[Column | str], Column]:
    """A column function: the tokens of a text (none of null) by the vocabulary at `path`, which the driver reads and sends to each
    executor once; `pattern` cuts texts into words. Special tokens' strings are ordinary text."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(shared.value, pattern)
        for batch in batches:
            yield batch.map(counter).astype("int64")
        counter.kept.clear()
        give_back()

    return count
