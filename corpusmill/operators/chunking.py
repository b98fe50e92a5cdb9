"""Texts to overlapping chunks with stable ids, and batches of chunks for an embedder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.characters import Characters
from .tables import dropped, give_back, placed, small_batches, written

SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def fixed_windows(text_: Column | str, size: int = 1000, overlap: int = 200) -> Column:
    """array<string>: stripped windows of `size` characters, each `size - overlap` on; blank ones left out."""
    t = text.col(text_)
    n = F.length(t)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((n - size) / F.lit(float(size - overlap))), F.lit(0)).cast("int"))
    return F.filter(F.transform(starts, lambda k: text.strip(F.substring(t, k * (size - overlap) + 1, F.lit(size)))), lambda s: s != "")


def _joined(pieces: Iterable[str | range], size: int, overlap: int, cut: Callable[[str | range], Iterable[str]] | None) -> Iterator[str]:
    """Chunks of short pieces; pieces of `size` or more are cut on, if there is a way to."""
    window: list[str] = []
    total = 0
    for piece in pieces:
        if len(piece) >= size and cut:
            if chunk := "".join(window).strip():
                yield chunk
            window, total = [], 0
            yield from cut(piece)
            continue
        if total + len(piece) > size:
            if chunk := "".join(window).strip():
                yield chunk
            drop = 0
            while total > overlap or (total and total + len(piece) > size):
                total -= len(window[drop])
                drop += 1
            window = window[drop:]
        window.append(piece)
        total += len(piece)
    if chunk := "".join(window).strip():
        yield chunk


def split_text(s: str, size: int = 1000, overlap: int = 200, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Cuts at the first separator that occurs, which stays at the start of the piece after it; pieces of
    `size` or more are cut on by the separators that follow. Short pieces are joined up to `size`, and a
    chunk begins with as many of the last pieces as `overlap` allows."""
    at = next(k for k, sep in enumerate(separators) if not sep or sep in s)
    sep, rest = separators[at], separators[at + 1 :]
    pieces = s if not sep else (x for x in (p if not k else sep + p for k, p in enumerate(s.split(sep))) if x)
    return list(_joined(pieces, size, overlap, (lambda p: split_text(p, size, overlap, rest)) if rest else None))


#: Characters of a piece that are held at once.
_HELD = 1 << 20


def _first_found(blocks: Iterable[str], separators: tuple[str, ...]) -> int:
    """The number of the first separator that occurs in the text that `blocks` make; the empty one always does."""
    best, kept, tail = next((k for k, sep in enumerate(separators) if not sep), len(separators)), "", max(map(len, separators)) - 1
    for block in blocks:
        kept += block
        best = next((k for k in range(best) if separators[k] in kept), best)
        if not best:
            break
        kept = kept[max(0, len(kept) - tail) :]
    return best


def _pieces(blocks: Iterable[str], start: int, sep: str, held: int | None) -> Iterator[str | range]:
    """The text that `blocks` make, from place `start` on, cut before each separator; of pieces over `held` characters (a separator less) where they lie."""
    if not sep:
        for block in blocks:
            yield from block
        return
    at, lead, kept, kept_at, long = start, "", "", start, False
    for block in blocks:
        kept += block
        first, *more = kept.split(sep)
        if more:
            if long:
                yield range(at, kept_at + len(first))
            elif lead or first:
                yield lead + first
            for piece in more[:-1]:
                yield sep + piece
            kept_at += len(kept) - len(more[-1])
            at, lead, kept, long = kept_at - len(sep), sep, more[-1], False
        long = long or (held is not None and len(kept) > held)
        if long:  # a separator may lie across two blocks
            gone = max(0, len(kept) - len(sep) + 1)
            kept_at, kept = kept_at + gone, kept[gone:]
    if long:
        yield range(at, kept_at + len(kept))
    elif lead or kept:
        yield lead + kept


def split_characters(text_: Characters, size: int = 1000, overlap: int = 200, separators: tuple[str, ...] = SEPARATORS, within: range | None = None) -> Iterator[str]:
    """The chunks of `split_text`, one after the other, of a text that is not held; pieces that are long are read again from where they lie."""
    within = range(text_.length) if within is None else within
    start, end = within.start, within.stop
    if end - start <= _HELD:
        yield from split_text("".join(text_.blocks(start, end)), size, overlap, separators)
        return
    at = _first_found(text_.blocks(start, end), separators)
    sep, rest = separators[at], separators[at + 1 :]

    def cut(piece: str | range) -> Iterable[str]:
        return split_text(piece, size, overlap, rest) if isinstance(piece, str) else split_characters(text_, size, overlap, rest, piece)

    yield from _joined(_pieces(text_.blocks(start, end), start, sep, max(_HELD, size + len(sep)) if rest else None), size, overlap, cut if rest else None)


def counted(chunks: Callable[[], Iterable[str]], held: int = 1 << 14) -> tuple[int, Iterable[str]]:
    """How many chunks there are, and the chunks. More than `held` are made twice, not held."""
    made = iter(chunks())
    first = list(islice(made, held))
    more = sum(1 for _ in made)
    return len(first) + more, chunks() if more else first


def chunked(docs: DataFrame, size: int = 1000, overlap: int = 200, separators: tuple[str, ...] | None = SEPARATORS, source: str = "source_path") -> DataFrame:
    """A row for each chunk of `docs` (text, `source`, any others): chunk_id, text, chunk_index, total_chunks and
    the other columns. Blank and null texts have none. With no separators the windows are fixed, in the JVM."""
    if separators is None:
        pieces = docs.withColumn("_chunks", fixed_windows("text", size, overlap))
    else:

        @F.pandas_udf("array<string>")
        def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield batch.map(lambda s: split_text(s, size, overlap, separators) if isinstance(s, str) and s.strip() else [])
            give_back()

        small_batches(docs.sparkSession)
        pieces = docs.withColumn("_chunks", cut("text"))
    others = [c for c in docs.columns if c not in ("text", "chunk_id", "chunk_index", "total_chunks")]
    rows = pieces.select(*others, F.size("_chunks").alias("total_chunks"), F.posexplode("_chunks").alias("chunk_index", "text"))
    return rows.select(chunk_id(source).alias("chunk_id"), "text", "chunk_index", "total_chunks", *others)


def chunk_id(source: str) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col(source), F.lit("unknown")), F.col("chunk_index").cast("string"), F.substring("text", 1, 50)))


#: Items in a segment; at least as many as a batch may hold.
_SEGMENT = 1 << 15


def _next_starts(tokens: np.ndarray, max_tokens: int, max_items: int) -> np.ndarray:
    """For each item, where the batch that begins with it ends and the next begins."""
    sums = np.concatenate([[0], np.cumsum(tokens)])
    i = np.arange(len(tokens))
    return np.clip(np.searchsorted(sums, sums[:-1] + max_tokens, "right") - 1, i + 1, i + max_items)


def _ways(table: pa.Table, size: int, max_tokens: int, max_items: int) -> pa.Table:
    """For each place where a batch may begin among a segment's first items: where the first batch of the next segment
    begins if one begins here (an offset in that segment), and how many batches begin before it."""
    at, tokens = table.column("_at").to_numpy(), table.column("_tokens").to_numpy()
    order = np.argsort(at)
    at, tokens = at[order], tokens[order]
    n, entries = int((at < size).sum()), min(int((at < size).sum()), max_items)
    to, begun = np.minimum(_next_starts(tokens, max_tokens, max_items), len(tokens)), np.ones(len(tokens), np.int64)
    here = np.flatnonzero(to[:n] < n)
    while here.size:  # pointers are doubled until all lead out of the segment
        begun[here] += begun[to[here]]
        to[here] = to[to[here]]
        here = here[to[here] < n]
    g, segment = table.column("_g")[0].as_py(), table.column("_segment")[0].as_py()
    return pa.table({"_g": [g] * entries, "_segment": [segment] * entries, "_entry": np.arange(entries), "_exit": to[:entries] - n, "_begun": begun[:entries]})


def _numbered(table: pa.Table, max_tokens: int, max_items: int) -> pa.Table:
    """Adds batch to a segment's rows, which know their segment's first start and the batches begun before it."""
    order = np.argsort(table.column("_i").to_numpy())
    table = table.take(pa.array(order))
    to = _next_starts(table.column("_tokens").to_numpy(), max_tokens, max_items)
    entry, before = table.column("_entry")[0].as_py(), table.column("_begun")[0].as_py()
    starts, at = np.zeros(len(order), np.int64), entry
    while at < len(order):
        starts[at] = 1
        at = int(to[at])
    return table.append_column("batch", pa.array(before - 1 + np.cumsum(starts)))


def _first_starts(rows: DataFrame, size: int, last: int, max_tokens: int, max_items: int) -> DataFrame:
    """_g, _segment, _entry (the place in the segment where its first batch begins) and _begun (batches before it), for `rows` (_g, _segment,
    _i, _tokens) in segments of `size` up to number `last`."""
    at = F.col("_i") - F.col("_segment") * size
    # A segment also sees the items that its last batch may take of the next.
    own, more = rows.select("_g", "_segment", at.alias("_at"), "_tokens"), rows.where((at < max_items) & (F.col("_segment") > 0))
    seen = own.unionByName(more.select("_g", (F.col("_segment") - 1).alias("_segment"), (at + size).alias("_at"), "_tokens"))
    ways = seen.groupBy("_g", "_segment").applyInArrow(lambda t: _ways(t, size, max_tokens, max_items), "_g string, _segment long, _entry long, _exit long, _begun long")
    step = written(ways)
    # Only starts that some start of the segment before leads to can ever be met.
    met = step.select("_g", (F.col("_segment") + 1).alias("_segment"), F.col("_exit").alias("_entry")).distinct()
    steps = [step, written(step.where("_segment = 0 AND _entry = 0").unionByName(step.where("_segment > 0").join(met, ["_g", "_segment", "_entry"], "left_semi")))]
    levels, span = [steps[1]], 1
    while span * 2 <= last:
        a = levels[-1].where(F.col("_segment") % (2 * span) == 0)
        b = levels[-1].select("_g", (F.col("_segment") - span).alias("_segment"), F.col("_entry").alias("_exit"), F.col("_exit").alias("_to"), F.col("_begun").alias("_more"))
        levels.append(written(a.join(b, ["_g", "_segment", "_exit"]).select("_g", "_segment", "_entry", F.col("_to").alias("_exit"), (F.col("_begun") + F.col("_more")).alias("_begun"))))
        span *= 2
    reached = [written(step.where("_segment = 0 AND _entry = 0").select("_g", "_segment", "_entry", F.lit(0).cast("long").alias("_begun")))]
    for level in reversed(levels):
        ahead = reached[-1].join(level.withColumnRenamed("_begun", "_more"), ["_g", "_segment", "_entry"])
        ahead = ahead.select("_g", (F.col("_segment") + span).alias("_segment"), F.col("_exit").alias("_entry"), (F.col("_begun") + F.col("_more")).alias("_begun"))
        reached.append(written(reached[-1].unionByName(ahead)))
        span //= 2
    dropped(*steps, *levels[1:], *reached[:-1])
    return reached[-1]


def token_batches(items: DataFrame, group: list[str], order: list[str], tokens: str, max_tokens: int = 8000, max_items: int = 2048) -> DataFrame:
    """Adds batch (from 0 in each group): in order, an item begins a new batch if it would bring the one before
    it over `max_tokens` or `max_items`. An item over `max_tokens` is a batch of its own; null tokens are none; rows that
    are equal in `order` come in any order; a null group is a group.

    What comes next hangs on all before, yet no task holds a group: it is cut into segments of a fixed number of items. A
    batch that begins at one of a segment's first `max_items` items leads to one start in the next segment. These pointers
    are doubled, joined with themselves over 2, 4, 8... segments, and followed from the group's first item to the first
    start of each segment, within which starts follow from each other."""
    size = max(_SEGMENT, max_items)
    names = [*items.columns, "batch"]
    laid = placed(items.withColumn("_tokens", F.coalesce(F.col(tokens), F.lit(0)).cast("long")), group, order)
    rows = written(laid.withColumn("_segment", F.floor(F.col("_i") / size)))
    dropped(laid)
    last = rows.agg(F.max("_segment")).first()[0] or 0
    first = _first_starts(rows, size, last, max_tokens, max_items) if last else written(rows.select("_g", "_segment", F.lit(0).cast("long").alias("_entry"), F.lit(0).cast("long").alias("_begun")).distinct())
    held = rows.join(first, ["_g", "_segment"])
    out = written(held.groupBy("_g", "_segment").applyInArrow(lambda t: _numbered(t, max_tokens, max_items), held.withColumn("batch", F.lit(0).cast("long")).schema).select(*names))
    dropped(rows, first)
    return out
