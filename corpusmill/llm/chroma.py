"""Chroma audio fingerprints: filters over an integral image of pitch-class frames give packed integers;
offset histograms and bit errors align recordings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

_CHUNK = 4096
#: Pairs of equal codes that are counted at a time, about.
_PAIRS = 1 << 20


@dataclass(frozen=True)
class Sound:
    """How recordings are read: PCM samples of one channel, unsigned of 8 bits or signed of 16 (little
    endian). Frames of `frame` samples start `hop` samples apart."""

    rate: int = 11025
    frame: int = 4096
    hop: int = 1365
    bits: int = 16

    def samples(self, data: bytes) -> np.ndarray:
        if self.bits == 8:
            return np.frombuffer(data, np.uint8).astype(np.float32) / 128 - 1
        return np.frombuffer(data[: len(data) // 2 * 2], "<i2").astype(np.float32) / 32768


@cache
def _pitches(sound: Sound) -> tuple[np.ndarray, np.ndarray]:
    """The window, and the matrix that sums the spectrum from 28 to 3520 Hz by pitch class."""
    hz = np.fft.rfftfreq(sound.frame, 1 / sound.rate)
    to = np.zeros((len(hz), 12), np.float32)
    heard = np.flatnonzero((hz >= 28) & (hz <= 3520))
    to[heard, np.floor(12 * np.log2(hz[heard] / 27.5)).astype(int) % 12] = 1
    return np.hanning(sound.frame).astype(np.float32), to


def chroma(data: bytes, sound: Sound) -> np.ndarray:
    """A row of 12 pitch-class energies for each frame, smoothed over five frames (a row less for each of
    the four at the ends) and scaled to length 1; silence stays 0. Frames are taken some at a time."""
    x = sound.samples(data)
    n = (len(x) - sound.frame) // sound.hop + 1
    if n < 5:
        return np.zeros((0, 12), np.float32)
    window, to = _pitches(sound)
    frames = np.lib.stride_tricks.sliding_window_view(x, sound.frame)[:: sound.hop]
    energy = np.concatenate([np.abs(np.fft.rfft(frames[a : a + _CHUNK] * window)) ** 2 @ to for a in range(0, n, _CHUNK)])
    smooth = sum(c * energy[k : n - 4 + k] for k, c in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    length = np.sqrt((smooth**2).sum(1, keepdims=True))
    return np.where(length > 0.01, smooth / np.maximum(length, 0.01), 0).astype(np.float32)


@cache
def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch, pitches, frames) of 16 filters by rule: the kinds in turn over widths from 2 to
    16 frames and bands that move through the pitches."""
    return [(k % 6, (5 * k) % (12 - h + 1), h, w) for k in range(16) for h, w in [((12, 4, 6, 3, 8, 6)[k % 6], (16, 4, 8, 12, 6, 10, 14, 2)[k % 8])]]


WIDEST = 16


def codes(image: np.ndarray) -> np.ndarray:
    """A 32-bit number for each place of a chroma image where the widest filter fits: the log ratio of two
    parts of each filter's area, summed in the integral image, in four levels, as two bits of Gray code."""
    n = len(image) - WIDEST + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        bands = total[:, p1] - total[:, p0]
        return bands[t1 : t1 + n] - bands[t0 : t0 + n]

    ratio = np.empty((16, n))
    for k, (kind, p, h, w) in enumerate(_filters()):
        q, whole = p + h, area(0, w, p, p + h)
        a = (
            lambda: whole,
            lambda: area(0, w, p + h // 2, q),
            lambda: area(w // 2, w, p, q),
            lambda: area(0, w // 2, p, p + h // 2) + area(w // 2, w, p + h // 2, q),
            lambda: area(0, w, p + h // 3, q - h // 3),
            lambda: area(w // 3, w - w // 3, p, q),
        )[kind]()
        b = area(0, w, 0, 12) - whole if kind == 0 and h < 12 else area(0, w, 0, 6) if kind == 0 else whole - a
        np.divide(1 + a, 1 + np.maximum(b, 0), out=ratio[k])
    np.log(ratio, out=ratio)
    level = (ratio > -0.15).astype(np.uint32) + (ratio > 0) + (ratio > 0.15)
    return np.bitwise_or.reduce((level ^ level >> np.uint32(1)) << np.arange(30, -1, -2, dtype=np.uint32)[:, None])


def fingerprint(data: bytes | None, sound: Sound) -> np.ndarray:
    """The codes of a recording; none of a null one, or of one too short for the widest filter."""
    return codes(chroma(data or b"", sound))


def offset_votes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many equal codes the recordings have at each offset, a's place less b's, from 1 - len(b) on. Pairs
    of equal codes are counted one by one, or for a code with very many of them by a correlation of its
    places, which has the same sums."""
    votes = np.zeros(len(a) + len(b) - 1)
    if not len(a) or not len(b):
        return votes
    size = 1 << int(np.ceil(np.log2(max(2, len(votes)))))
    order = np.argsort(b, kind="stable")
    own, place, n_a = np.unique(a, return_inverse=True, return_counts=True)
    first, end = np.searchsorted(b[order], own, "left"), np.searchsorted(b[order], own, "right")
    n_b = end - first
    hot = n_a * n_b > 64 * size
    pairs = np.where(hot, 0, n_b)[place]
    upto = np.cumsum(pairs)
    at = 0
    while at < len(a) and upto[-1]:  # some places of a at a time
        done = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, done + _PAIRS, "right")))
        n = pairs[at:to]
        each = np.repeat(np.arange(at, to), n)
        of_b = order[first[place[each]] + np.arange(len(each)) - np.repeat(upto[at:to] - n - done, n)]
        votes += np.bincount(each - of_b + len(b) - 1, minlength=len(votes))
        at = to
    for code in own[hot]:
        pa, pb = np.flatnonzero(a == code), np.flatnonzero(b == code)
        ia, ib = np.bincount(pa, minlength=len(a)), np.bincount(len(b) - 1 - pb, minlength=len(b))
        votes += np.rint(np.fft.irfft(np.fft.rfft(ia, size) * np.fft.rfft(ib, size), size))[: len(votes)]
    return votes


def align(a: np.ndarray, b: np.ndarray, best: int = 5, least: int = 16) -> tuple[int | None, int, float]:
    """(offset, votes, bit error): of the `best` offsets with most votes (ties: the smallest distance, then
    the smaller), the one with the least share of unequal bits where the recordings overlap by `least`
    codes. None, 0 and 0.5 where there is none."""
    found = (None, 0, 0.5)
    if not len(a) or not len(b):
        return found
    votes = offset_votes(a, b)
    offsets = np.arange(len(votes)) - (len(b) - 1)
    for i in np.lexsort((offsets, np.abs(offsets), -votes))[:best]:
        at = int(offsets[i])
        x, y = a[max(0, at) :], b[max(0, -at) :]
        n = min(len(x), len(y))
        if votes[i] and n >= min(least, len(a), len(b)):
            wrong = float(np.bitwise_count(x[:n] ^ y[:n]).sum()) / (32 * n)
            if found[0] is None or wrong < found[2]:
                found = (at, int(votes[i]), wrong)
    return found


def fingerprints(recordings: DataFrame, sound: Sound) -> DataFrame:
    """The columns of `recordings` (data: binary; others kept) without data, with codes (array<long>) and
    n_frames (columns of these names are replaced). Each recording is read whole where it is."""
    small_batches(recordings.sparkSession)
    recordings = recordings.drop("codes", "n_frames")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = batch.pop("data")
            yield batch.assign(codes=[fingerprint(d, sound).astype(np.int64) for d in data], n_frames=[max(0, (len(d or b"") * 8 // sound.bits - sound.frame) // sound.hop + 1) for d in data])

    return recordings.mapInPandas(run, recordings.drop("data").withColumns({"codes": F.array().cast("array<long>"), "n_frames": F.lit(0).cast("long")}).schema)


def aligned(pairs: DataFrame) -> DataFrame:
    """Adds offset (long), votes (long) and bit_error (double) to `pairs` (a, b: codes of two recordings)."""
    pairs = pairs.drop("offset", "votes", "bit_error")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [align(np.asarray(a, np.int64).astype(np.uint32), np.asarray(b, np.int64).astype(np.uint32)) for a, b in zip(batch["a"], batch["b"], strict=True)]
            yield batch.assign(offset=pd.array([x[0] for x in found], "Int64"), votes=[x[1] for x in found], bit_error=[x[2] for x in found])

    return pairs.mapInPandas(run, pairs.withColumns({"offset": F.lit(None).cast("long"), "votes": F.lit(0).cast("long"), "bit_error": F.lit(0.0)}).schema)


def excerpts(recordings: DataFrame, sound: Sound) -> DataFrame:
    """For each row of `recordings` (doc_id, data): doc_id, n_frames, n_codes, fingerprint (hex digest of its
    codes), class_id (the least doc_id with the same codes; its own where it has none), cut (how many hops
    into it an excerpt starts: a quarter), and offset, votes, bit_error of the excerpt, fingerprinted anew,
    aligned with it. Too short ones have no codes and no offset. Repeated rows give a row each."""
    small_batches(recordings.sparkSession)
    width = sound.bits // 8

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch["doc_id"], batch["data"], strict=True):
                data = data or b""
                own = fingerprint(data, sound)
                cut = len(data) // width // 4 // sound.hop
                found = align(own, fingerprint(data[cut * sound.hop * width :], sound))
                frames = max(0, (len(data) // width - sound.frame) // sound.hop + 1)
                rows.append((doc_id, frames, len(own), hashlib.sha256(own.astype("<u4").tobytes()).hexdigest(), cut, *found))
            out = pd.DataFrame(rows, columns=["doc_id", "n_frames", "n_codes", "fingerprint", "cut", "offset", "votes", "bit_error"])
            yield out.astype({"offset": "Int64"})

    kind = recordings.schema["doc_id"].dataType.simpleString()
    found = recordings.select("doc_id", "data").mapInPandas(run, f"doc_id {kind}, n_frames long, n_codes long, fingerprint string, cut long, offset long, votes long, bit_error double")
    found = written(found)
    # Written, so that both sides of the join are dealt out for it and a hot class's rows can be split.
    least = written(found.where(F.col("n_codes") > 0).groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")))
    return found.join(least, "fingerprint", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
