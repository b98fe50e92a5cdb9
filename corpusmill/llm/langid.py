"""Language ID by rank-order profiles: the out-of-place distance between a document's most frequent
n-grams and those of each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import give_back, small_batches

#: Returned where a text has nothing to tell a language by.
UNDETERMINED = "und"
_SPACE = 32
_PIECE = 1 << 19


@dataclass(frozen=True)
class Profiles:
    """For each language the ranks of its most frequent n-grams: at most `size` a language, and at
    most `max_languages` languages, so the model's size is bounded whatever it was learned from."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.where(_letters()[codes], codes, _SPACE).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 1- to 3-grams of the lower-cased text (three 21-bit code points in a long) and
    their counts. All that is no letter counts as space, runs of spaces as one; grams of one space,
    or with a space inside, are left out. Long texts go piece by piece, so memory is bounded."""
    parts = []
    carry = np.array([_SPACE], np.int64)
    text = text or ""
    for at in range(0, max(1, len(text)), _PIECE):
        last = at + _PIECE >= len(text)
        new = _codes(text[at : at + _PIECE])
        x = np.concatenate([carry, new, [_SPACE]] if last else [carry, new])
        fresh = np.arange(len(x)) >= len(carry)
        keep = np.r_[True, (x[1:] != _SPACE) | (x[:-1] != _SPACE)]
        x, fresh = x[keep], fresh[keep]
        if len(x) > 1:
            two = x[1:] | x[:-1] << 21
            grams = [x[fresh & (x != _SPACE)], two[fresh[1:]]]
            if len(x) > 2:
                grams.append((two[1:] | x[:-2] << 42)[fresh[2:] & (x[1:-1] != _SPACE)])
            parts.append(_counted(np.concatenate(grams)))
        carry = x[-2:]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return parts[0] if len(parts) == 1 else _merged(parts)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams.sort()
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.diff(np.r_[first, len(grams)])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)


def most_frequent(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent grams in the order of their rank; ties by code points."""
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        kept = counts >= least
        grams, counts = grams[kept], counts[kept]
    return grams[np.lexsort((grams, -counts))][:size]


def _partial_counts(batches: Iterator[pd.DataFrame], at_once: int = 64) -> Iterator[pd.DataFrame]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            parts = held.setdefault(lang, [])
            parts.append(gram_counts(text))
            if len(parts) >= at_once:
                held[lang] = [_merged(parts)]
                if len(held[lang][0][0]) > 200_000:
                    yield _partial(lang, held.pop(lang))
    for lang, parts in held.items():
        yield _partial(lang, parts)


def _partial(lang: str, parts: list) -> pd.DataFrame:
    grams, counts = _merged(parts)
    return pd.DataFrame({"lang": lang, "gram": grams, "n": counts})


def learn(docs: DataFrame, size: int = 400, max_languages: int = 4096) -> Profiles:
    """Profiles from all rows of `docs` with a `lang`: n-grams are counted in the tasks, summed by
    (language, n-gram), and the `size` most frequent of each language reach the driver.

    Rows without `lang` teach nothing; null and empty texts add a language without n-grams. No rows
    give no languages. More than `max_languages` languages are an error: the bound on the model."""
    small_batches(docs.sparkSession)
    counts = docs.where(F.col("lang").isNotNull()).select("lang", "text").mapInPandas(_partial_counts, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size)
    rows = ranked.select("lang", "gram", "rank").limit(size * max_languages + 1).toPandas()
    languages = sorted(rows["lang"].unique())
    if len(rows) > size * max_languages or len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    grams = np.unique(rows["gram"].to_numpy(np.int64))
    ranks = np.full((len(languages), len(grams)), size, np.int32)
    place = {lang: i for i, lang in enumerate(languages)}
    ranks[[place[x] for x in rows["lang"]], np.searchsorted(grams, rows["gram"])] = rows["rank"].to_numpy() - 1
    return Profiles(languages, grams, ranks, size)


def closest(text: str | None, model: Profiles) -> tuple[str, float]:
    """The language with the least out-of-place distance (ties: the first by name), and 1 less that
    distance as a share of the largest possible one. No letter, or no model: `und` and 0."""
    grams, counts = gram_counts(text)
    if not len(grams) or not model.languages:
        return UNDETERMINED, 0.0
    own = most_frequent(grams, counts, model.size)
    at = np.minimum(np.searchsorted(model.grams, own), len(model.grams) - 1)
    theirs = np.where(model.grams[at] == own, model.ranks[:, at], model.size)
    away = np.where(theirs < model.size, np.abs(theirs - np.arange(len(own))), model.size).sum(1)
    best = int(away.argmin())
    return model.languages[best], 1 - float(away[best]) / (len(own) * model.size)


def predict(docs: DataFrame, model: Profiles) -> DataFrame:
    """Adds lang_pred and score to `docs`, which keeps its other columns (its own columns of these
    names are replaced). Only `text` is looked at."""
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [closest(x, shared.value) for x in batch.pop("text")]
            yield batch.assign(lang_pred=[x for x, _ in found], score=[x for _, x in found])
        give_back()

    schema = docs.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.mapInPandas(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of documents that nothing is learned from; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
