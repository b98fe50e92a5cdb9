"""Token counts of whole texts: huge ones are encoded in overlapping chunks, spread over tasks, and spliced where two
chunks provably agree."""

from __future__ import annotations

import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, give_back, small_batches, written
from .packing import _encoder

_PARTS = "key string, chunk long, last boolean, tokens long, head_at array<long>, head_before array<long>, tail_at array<long>, tail_before array<long>"


@cache
def _joins() -> frozenset[str]:
    """Characters that normalization may join to what precedes them: combining marks and the second halves of canonical
    compositions, Hangul vowels and finals too."""
    found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for code in range(0x300, 0x110000):
        if unicodedata.combining(c := chr(code)):
            found.add(c)
        halves = unicodedata.decomposition(c)
        if halves and halves[0] != "<" and " " in halves:
            found.add(chr(int(halves.split()[1], 16)))
    return frozenset(found)


def _opens(c: str) -> bool:
    """Whether a text cut before `c` is normalized part by part, and `c` to one character, so that no word begins within it."""
    return c < "\u0100" or c not in _joins() and len(unicodedata.normalize("NFC", c).lower()) == 1


def boundaries(tokenizer, text: str, ends: bool) -> tuple[int, list[int], list[int]]:
    """The tokens of `text`, the places of its words that another chunk may share and the tokens before each.

    The tokenizer scans special strings and words from left to right, each match hangs on what follows its start only,
    and tokens do not cross words. So two scans that both have a word start at one place agree from there on, as far
    as both texts reach: what is after such a place needs nothing of what is before it. Left out are the places of words that
    the end of the chunk may cut (the last one, and what is nearer to the end than a special string is long, unless the text itself `ends` there) and
    those before a character that normalization may join to the one before. The end of the text is a place, too."""
    encoded = tokenizer.encode(text, add_special_tokens=False)
    words, offsets = encoded.word_ids, encoded.offsets
    first = [k for k in range(len(words)) if k == 0 or words[k] != words[k - 1]]
    if not ends:
        special = max((len(x.content) for x in tokenizer.get_added_tokens_decoder().values()), default=0)
        first = [k for k in first[:-1] if offsets[k][0] <= len(text) - special]
    first = [k for k in first if _opens(text[offsets[k][0]])]
    at, before = [offsets[k][0] for k in first], list(first)
    if ends:
        at, before = [*at, len(text)], [*before, len(words)]
    return len(words), at, before


def _first_pass(path: str, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        most = chunk if encoder.by_word else sys.maxsize
        for b in batches:
            texts = b.column("text").to_pylist()
            short = iter([len(x) // 4 for x in encoder([t for t in texts if len(t) <= most])])
            tokens = [next(short) if len(t) <= most else None for t in texts]
            keys = [None if len(t) <= most else hashlib.sha256(t.encode()).hexdigest() for t in texts]
            columns = [b.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array(keys, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "key"])
        encoder.old = {}
        give_back()

    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, text in zip(b["key"], b["text"]):
                starts = range(0, len(text), chunk)
                yield pd.DataFrame({"key": key, "chunk": range(len(starts)), "ends": [s + chunk + overlap >= len(text) for s in starts], "last": [s + chunk >= len(text) for s in starts], "text": [text[s : s + chunk + overlap] for s in starts]})

    return run


def _encode(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _encoder(path).tokenizer
        for b in batches:
            rows = []
            for row in b.itertuples(index=False):
                tokens, at, before = boundaries(tokenizer, row.text, row.ends)
                start = row.chunk * chunk
                head = [(start + a, n) for a, n in zip(at, before) if a < overlap or row.last] if row.chunk else []
                tail = [(start + a, n) for a, n in zip(at, before) if a >= chunk] if not row.last else []
                rows.append((row.key, row.chunk, row.last, tokens, [a for a, _ in head], [n for _, n in head], [a for a, _ in tail], [n for _, n in tail]))
            yield pd.DataFrame(rows, columns=["key", "chunk", "last", "tokens", "head_at", "head_before", "tail_at", "tail_before"])
        give_back()

    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """key, n_tokens for each different text: the tokens of its chunks without what two of them both have. n_tokens is null
    where two neighbours share no place."""
    parts = texts.mapInPandas(_cut(chunk, overlap), "key string, chunk long, ends boolean, last boolean, text string")
    # Chunks of one text go to many tasks; copies of a text are the same rows afterwards.
    parts = written(parts.hint("rebalance").mapInPandas(_encode(path, chunk, overlap), _PARTS).dropDuplicates(["key", "chunk"]))
    left = parts.where(~F.col("last")).select("key", (F.col("chunk") + 1).alias("chunk"), F.col("tokens").alias("left_tokens"), "tail_at", "tail_before")
    seams = left.join(parts.select("key", "chunk", "head_at", "head_before"), ["key", "chunk"])
    seams = seams.withColumn("p", F.array_min(F.array_intersect("tail_at", "head_at")))
    taken = F.element_at("tail_before", F.array_position("tail_at", F.col("p")).cast("int"))
    left_out = F.element_at("head_before", F.array_position("head_at", F.col("p")).cast("int"))
    seams = seams.select("key", F.when(F.col("p").isNotNull(), taken - F.col("left_tokens") - left_out).alias("more"))
    both = parts.select("key", F.col("tokens").alias("more")).unionByName(seams)
    counted = written(both.groupBy("key").agg(F.sum("more").alias("n_tokens"), F.bool_and(F.col("more").isNotNull()).alias("whole")).select("key", F.when(F.col("whole"), F.col("n_tokens")).alias("n_tokens")))
    dropped(parts)
    return counted


def token_counts(docs: DataFrame, path: str, limit: int = 2048, chunk: int = 32_768, overlap: int = 1_024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row's whole text, as the tokenizer's library counts them without
    special tokens of its own.

    Texts of up to `chunk` characters are encoded as they are. Longer ones are cut into chunks with `overlap` more
    characters each; the texts in which two neighbours share no place are cut again, four times as wide in both, until all
    are spliced or one chunk: no text is left out. A tokenizer whose rules are not known encodes whole texts.
    Null counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids are rows of their own, other columns are not
    looked at, an empty table gives an empty one. `path` is the tokenizer's file, which every executor has."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = written(rows.mapInArrow(_first_pass(path, chunk), f"doc_id {kind}, n_bytes long, n_tokens long, key string"))
    done = first.where(F.col("key").isNull()).drop("key")
    open_keys, tables = first.where(F.col("key").isNotNull()).select("key").distinct(), [first]
    size, counted = chunk, None
    texts = rows.where(F.char_length("text") > chunk).select(F.sha2("text", 256).alias("key"), "text")
    while not open_keys.isEmpty():
        found = _spliced(texts if counted is None else texts.join(open_keys, "key", "left_semi"), path, size, overlap)
        tables.append(found)
        good = found.where(F.col("n_tokens").isNotNull())
        counted = good if counted is None else counted.unionByName(good)
        open_keys, size, overlap = found.where(F.col("n_tokens").isNull()).select("key"), size * 4, overlap * 4
    if counted is not None:
        done = done.unionByName(first.where(F.col("key").isNotNull()).drop("n_tokens").join(counted, "key").drop("key"))
    result = written(done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
    dropped(*tables)
    return result
