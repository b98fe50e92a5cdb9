"""From raw documents to packed sequences: five stages, each an operator of `corpusmill.llm` applied to all
that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import langid, minhash, mixing, packing, suffixes
from corpusmill.llm.common import dropped, table, written

#: Below this likeness to the closest profile a text is in none of the languages.
LEAST_LIKENESS = 0.2

#: Near copies have this percentage of their shingles in common; 35 bands of 5 coordinates miss a pair at the
#: threshold with probability (1 - 0.8^5)^35 < 1e-6.
PERCENT, BANDS, ROWS = 80, 35, 5


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """`docs` with its columns other than `used` under names that no operator uses."""
    return docs.select(*used, *[F.col(f"`{c}`").alias(f"_other{i}") for i, c in enumerate(docs.columns) if c not in used])


def _back(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of `docs` out of what an operator made of `_apart`."""
    return rows.select(*[F.col(c) if c in used else F.col(f"_other{i}").alias(c) for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: what has no letters (null and empty texts, too), and what is like none of the languages learned from the
    documents' own lang (all but the held-out quarter). Clean texts in any of these languages stay, whatever
    their lang says; equal texts fare alike, so repeated rows stay or go together. Where no row has a lang,
    nothing is known and all rows go. An empty table gives an empty one."""
    model = langid.learn(docs.where(~langid.held_out()))
    found = langid.predict(_apart(docs, "text").withColumn("_text", F.col("text")), model)
    rejected = (F.col("lang_pred") == langid.UNDETERMINED) | (F.col("score") < LEAST_LIKENESS)
    return _back(found.where(~rejected).withColumnRenamed("_text", "text"), docs, "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the least doc_id (null before all others), and of
    repeated rows the first of them in the table. So rows that share a doc_id, or have none, are compared by their
    texts like any others. Null and blank texts are no copies of anything and stay. An empty table gives an
    empty one."""
    used = ("doc_id", "text")
    rows = written(_apart(docs, *used).withColumn("_row", F.monotonically_increasing_id()))
    found = minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), percent=PERCENT, bands=BANDS, rows=ROWS)
    grouped = written(found.select(F.col("doc_id").alias("_row"), "component_id"))
    # Groups of one row need no choice.
    many = grouped.groupBy("component_id").count().where(F.col("count") > 1).select("component_id")
    some = written(grouped.join(many, "component_id").join(rows.select("_row", "doc_id"), "_row"))
    stays = some.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("_row"))
    gone = written(some.select("_row").join(stays.select("_row"), "_row", "left_anti"))
    dropped(grouped, some)
    return _back(rows.join(gone, "_row", "left_anti"), docs, *used)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that an earlier document (or place) has leave the text, with the characters
    that this would cut in two. A document of which nothing is left goes; a text without repeats stays as it
    is, null too. Rows with equal doc_id and text count as one document and all stay (the stage before leaves
    no such rows). An empty table gives an empty one."""
    used = ("doc_id", "text", "n_chars")
    cut = suffixes.without_repeats(_apart(docs, *used), keep="first", whole=True)
    cut = cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return _back(cut.withColumn("n_chars", F.length("text").cast("long")), docs, *used)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each use of a document, at most two; the last one that a
    source gives may be cut short. Texts without words (null ones, too) take part in nothing and go; a null
    source is a source; repeated rows count each. An empty table gives an empty one."""
    used = ("doc_id", "source", "text", "n_chars")
    apart = _apart(docs, *used)
    return _back(mixing.mixed_documents(mixing.mix(apart, keep_text=True), apart.columns), docs, *used)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens in as few sequences as best fit finds. A null or empty text is its closing token
    alone; repeated rows get places of their own; an empty table gives an empty one."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("MinHash near-dedup", near_duplicates), ("suffix-array dedup", repeated_passages), ("mixing sources", mixture), ("best-fit packing", packed)]

#: Profiles, hashes and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and reread as the next one's documents; a stage's table is deleted once the next is
    written. The last stage has read its own before it returns."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            dropped(before)
        before = docs
    packed_rows = STAGES[-1][1](spark, docs, sf_dir)
    if before is not None:
        dropped(before)
    return packed_rows
