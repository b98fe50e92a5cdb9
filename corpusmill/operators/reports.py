"""Counts for project pages and indexes, and the pages as lines of Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text


def format_counts(files: DataFrame, tracked: list[str] = rules.TRACKED_EXTENSIONS) -> DataFrame:
    """project, file_count (all files) and formats (array of struct(ext, n), tracked ones, by extension)."""
    each = files.groupBy("project", "ext").agg(F.count("*").alias("n"))
    known = F.when(F.col("ext").isin(tracked), F.struct("ext", "n"))
    return each.groupBy("project").agg(F.sum("n").alias("file_count"), F.sort_array(F.collect_list(known)).alias("formats"))


def top_formats(formats: str = "formats", n: int = 3) -> Column:
    """The n most frequent as text, `ext:n` by count, ties by extension."""
    best = F.array_sort(F.transform(formats, lambda x: F.struct((-x["n"]).alias("n"), x["ext"].alias("ext"))))
    return F.array_join(F.transform(F.slice(best, 1, n), lambda x: F.concat(x["ext"], F.lit(":"), (-x["n"]).cast("string"))), ", ")


def by_year(pages: DataFrame) -> DataFrame:
    """year (of period_start, or `undated`), projects, files, and place: years from the last, undated at the end."""
    year = F.coalesce(F.nullif(F.substring("period_start", 1, 4), F.lit("")), F.lit("undated"))
    out = pages.groupBy(year.alias("year")).agg(F.count("*").alias("projects"), F.sum("file_count").alias("files"))
    return out.orderBy((F.col("year") == "undated").cast("int"), F.desc("year"))


def page_fields(pages: DataFrame, new: DataFrame, forced: list[str], defaulted: list[str], key: str = "id") -> DataFrame:
    """Pages with the new values of `forced` fields, and of `defaulted` ones only where the page has none."""
    old = pages.select(key, *[F.col(c).alias(f"_{c}") for c in defaulted])
    rows = new.join(old, key, "left")
    return rows.select(key, *forced, *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in defaulted])


def table_lines(rows: DataFrame, group: list[str], order: list[str], cells: list[str], header: list[str]) -> DataFrame:
    """group, place, line: a Markdown table for each group, a line a row, for `write.text` by group."""
    from pyspark.sql.window import Window

    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[text.md_escape(F.col(c).cast("string")) for c in cells]), F.lit(" |"))
    body = rows.select(*group, (F.row_number().over(Window.partitionBy(*group).orderBy(*order)) + 2).alias("place"), line.alias("line"))
    top = [f"| {' | '.join(header)} |", f"|{'|'.join('---' for _ in header)}|"]
    heads = rows.select(*group).distinct().select(*group, F.posexplode(F.array(*map(F.lit, top))).alias("place", "line")).withColumn("place", F.col("place") + 1)
    return heads.unionByName(body)


def front_matter(fields: list[str]) -> Column:
    """A YAML header of the columns, each as a JSON scalar (which YAML reads)."""
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.to_json(F.struct(F.col(c).alias("v"))), F.lit('{"v":null}'))) for c in fields]
    bare = [F.regexp_replace(F.regexp_replace(x, r'\{"v":(.*)\}$', "$1"), r": \{\}$", ": null") for x in lines]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *bare), F.lit("\n---\n"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One CSV file with a header, in order; a manifest is as small as a list of chosen documents is."""
    manifest.orderBy("project_slug", "doc_key", "source_rel").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
