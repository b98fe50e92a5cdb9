"""Structured records out of documents: which documents count, whose they are, and what recurs in them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules, text
from ..functions.resilience import with_retries


def has_any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | x.contains(w)
    return out


def is_requirement_document(parts: Column, word: str = rules.REQUIREMENT_WORD, include: list[str] = rules.REQUIREMENT_INCLUDE, prefix: str = rules.REQUIREMENT_PREFIX, exclude: list[str] = rules.REQUIREMENT_EXCLUDE, folders: list[str] = rules.REQUIREMENT_EXCLUDE_FOLDERS) -> Column:
    """Of the parts of a path: the name has `word` and one of `include` or begins with `prefix`, none of
    `exclude`, is no lock file, and no folder above has any of `folders`."""
    name = F.element_at(parts, -1)
    above = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    return ~name.startswith("~$") & name.contains(word) & ~has_any(name, exclude) & ~has_any(above, folders) & (has_any(name, include) | name.startswith(prefix))


def primary(manifest: DataFrame, group: list[str] = ["project_slug", "doc_key"]) -> DataFrame:  # noqa: B006
    """Adds is_primary: the newest of each logical document by version, date, modification time, size; ties by
    source_rel. `manifest` has version (as text.version_numbers), date, mtime, size. The best of a group is a maximum,
    summed before the shuffle, so a group may be large."""
    rank = F.struct("version", "date", "mtime", "size")
    best = manifest.groupBy(*group).agg(F.max(rank).alias("_rank"))
    rows = manifest.join(best, group).withColumn("_top", rank == F.col("_rank"))
    first = rows.where("_top").groupBy(*group).agg(F.min("source_rel").alias("_first"))
    return rows.join(first, group).withColumn("is_primary", F.col("_top") & (F.col("source_rel") == F.col("_first"))).drop("_rank", "_top", "_first")


def with_project(files: DataFrame, slugs: DataFrame, parts: str = "parts") -> DataFrame:
    """Adds project_slug and project_title from `slugs` (raw_name, slug, title, is_yearly), which is as small as a
    list of projects is. A named project is looked up; in a year's folder the sub-folder is the project, with
    the period's year before it; any other folder names itself."""
    known = slugs.select(F.col("raw_name").alias("_top"), F.col("slug").alias("_slug"), F.col("title").alias("_title"), F.coalesce("is_yearly", F.lit(False)).alias("_yearly"))
    rows = files.withColumn("_top", F.element_at(parts, 1)).join(known, "_top", "left")
    sub = F.get(F.col(parts), F.lit(1))
    year, name = F.regexp_extract(sub, text.java(rules.PERIOD_FOLDER), 1), text.strip(F.regexp_extract(sub, text.java(rules.PERIOD_FOLDER), 5))
    own = text.slugify("_top")
    named = F.col("_slug").isNotNull() & ~F.col("_yearly")
    yearly = F.coalesce(F.col("_yearly"), F.lit(False)) | F.col("_top").rlike(text.java(rules.YEARLY_PREFIX))
    inner = yearly & (F.size(parts) >= 2)
    slug = F.when(named, F.col("_slug")).when(inner & (year != ""), F.concat_ws("-", year, text.slugify(name))).when(inner, F.concat_ws("-", own, text.slugify(sub))).otherwise(own)
    title = F.when(named, F.coalesce("_title", "_top")).when(inner & (year != ""), name).when(inner, sub).otherwise(F.col("_top"))
    return rows.withColumns({"project_slug": slug, "project_title": title}).drop("_top", "_slug", "_title", "_yearly")


def extracted(docs: DataFrame, extract: Callable[[str, str], str], known: DataFrame | None = None, least: int = 30, most: int = 60_000) -> DataFrame:
    """Adds requirements (array of structs) and error to `docs` (source_rel, source_file, text, others): what `extract`, a
    model's answer to (text, file name), has as JSON. Texts go in by their first `most` characters; shorter ones
    than `least` are an error, as are answers without JSON. Documents that `known` (source_rel) has are left out."""
    if known is not None:
        docs = docs.join(known.select("source_rel"), "source_rel", "left_anti")
    docs = docs.drop("requirements", "error").withColumn("_text", F.substring("text", 1, most))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for body, name in zip(batch["_text"], batch["source_file"], strict=True):
                if len((body or "").strip()) < least:
                    rows.append((None, "too short"))
                    continue
                try:
                    rows.append((with_retries(lambda body=body, name=name: extract(body, name)), None))
                except Exception as e:  # one document must not end the job; its cause is kept
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield batch.assign(_answer=[x for x, _ in rows], error=[x for _, x in rows])

    text_ = F.lit(None).cast("string")
    answers = docs.mapInPandas(ask, docs.withColumns({"_answer": text_, "error": text_}).schema)
    found = text.json_payload("_answer", "requirements array<struct<req_name: string, req_detail: string, req_type: string, strategy: string, source_loc: string>>")["requirements"]
    return answers.withColumn("requirements", found).withColumn("error", F.coalesce("error", F.when(F.col("requirements").isNull(), "no JSON"))).drop("_text", "_answer")


def items(extractions: DataFrame) -> DataFrame:
    """A row for each requirement of `extractions` (…, requirements: array of structs), with pos from 0."""
    others = [c for c in extractions.columns if c != "requirements"]
    return extractions.select(*others, F.posexplode("requirements").alias("pos", "_r")).select(*others, "pos", "_r.*")


def valid_type(kind: str, known: list[str] = rules.REQUIREMENT_TYPES, other: str = rules.REQUIREMENT_TYPES[-1]) -> Column:
    return F.when(F.col(kind).isin(known), F.col(kind)).otherwise(other)


def has_strategy(strategy: str = "strategy") -> Column:
    s = F.col(strategy)
    return F.coalesce((s != "") & (s != rules.NO_STRATEGY), F.lit(False))


def running_ids(rows: DataFrame, project: str = "project_slug") -> DataFrame:
    """Adds req_id, R-001 and so on through a project's files in order. What a file begins with is summed over
    the project's files, and within a file it is the place, so no window holds a project."""
    files = rows.groupBy(project, "source_file").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(project).orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(project, "source_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(project, "source_file").orderBy("pos"))
    return rows.withColumn("_place", place).join(files, [project, "source_file"]).withColumn("req_id", F.format_string("R-%03d", F.col("_before") + F.col("_place"))).drop("_place", "_before")


def synthesized(rows: DataFrame) -> DataFrame:
    """chunk_id and text of each requirement for the vector collection."""
    strategy = F.when(has_strategy(), F.concat(F.lit("\n[strategy] "), F.col("strategy"))).otherwise("")
    body = F.concat(F.lit("["), F.col("project_title"), F.lit("] "), F.col("name"), F.lit(" — "), F.col("detail"), F.lit(" ("), F.col("type"), F.lit(")"), strategy)
    number = F.format_string("%03d", F.col("pos") + 1)
    return rows.select(F.concat(F.col("project_slug"), F.lit("#R-"), number, F.lit("__"), text.stem("source_file")).alias("chunk_id"), body.alias("text"), F.coalesce(F.nullif(F.regexp_extract(F.concat_ws(" ", "project_slug", "source_file"), text.java(rules.YEAR), 0), F.lit("")), F.lit("")).alias("year"))


def type_rollup(rows: DataFrame, project: str = "project_slug", kind: str = "type") -> DataFrame:
    """Counts by project and type, by project, and over all: one pass, with sums before the shuffle."""
    return rows.rollup(project, kind).agg(F.count("*").alias("n"))


def type_distribution(rows: DataFrame, order: list[str], kind: str = "type") -> DataFrame:
    counts = rows.groupBy(kind).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(kind))
    share = F.round(F.lit(100.0) * F.col("n") / F.col("total"), 1)
    return counts.crossJoin(F.broadcast(total)).select(kind, "n", share.alias("percent"), F.when(place > 0, place).otherwise(len(order) + 1).cast("int").alias("place")).orderBy("place", kind)


def with_themes(rows: DataFrame, words: Column, table: list = rules.THEMES) -> DataFrame:
    """A row for each theme that a requirement's `words` belong to."""
    return rows.withColumn("theme", F.explode(text.labels(words, table)))


def theme_stats(tagged: DataFrame, project: str = "project_slug") -> DataFrame:
    """theme, n, projects, n_strategy and rank: by projects, then by n, then by name. There are as many rows as
    themes. Distinct projects are counted from one row for each theme and project."""
    each = tagged.groupBy("theme", project).agg(F.count("*").alias("n"), F.count_if(has_strategy()).alias("n_strategy"))
    out = each.groupBy("theme").agg(F.sum("n").alias("n"), F.count(project).alias("projects"), F.sum("n_strategy").alias("n_strategy"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("projects"), F.desc("n"), "theme")))


def thin_themes(stats: DataFrame, least: int = 20, share: float = 0.1) -> DataFrame:
    return stats.where((F.col("n") >= least) & (F.col("n_strategy") < F.col("n") * F.lit(share)))


def theme_examples(tagged: DataFrame, n: int = 5, key: list[str] = ["source_file", "pos"]) -> DataFrame:  # noqa: B006
    """The n requirements of each theme with a strategy first, then by length of detail; each task keeps n."""
    order = Window.partitionBy("theme").orderBy(F.desc(has_strategy()), F.desc(F.length("detail")), *key)
    return tagged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def theme_projects(tagged: DataFrame, shown: int = 8, project: str = "project_slug") -> DataFrame:
    """theme, projects (text): the first names, and how many more there are."""
    each = tagged.where(F.col(project).isNotNull()).select("theme", project).distinct()
    many = tagged.groupBy("theme").agg(F.count_distinct(project).alias("_n"))
    # Each task keeps the first names only.
    first = each.withColumn("_place", F.row_number().over(Window.partitionBy("theme").orderBy(project))).where(F.col("_place") <= shown)
    first = first.groupBy("theme").agg(F.sort_array(F.collect_list(project)).alias("_names"))
    more = F.when(F.col("_n") > shown, F.concat(F.lit(" + "), (F.col("_n") - shown).cast("string"), F.lit(" more"))).otherwise("")
    out = many.join(first, "theme", "left")
    return out.select("theme", F.concat(F.array_join(F.coalesce("_names", F.array().cast("array<string>")), ", "), more).alias("projects"))
