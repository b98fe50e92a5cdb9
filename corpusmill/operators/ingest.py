"""From file rows to validated text with metadata, and what became of each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text


def with_extension(files: DataFrame, extensions: list[str] = rules.TARGET_EXTENSIONS, limit: int | None = None) -> DataFrame:
    """Rows whose lower-cased extension is wanted, with `ext`; at most `limit`, by path, if it is given."""
    out = files.withColumn("ext", text.suffix("path")).where(F.col("ext").isin(extensions))
    return out.orderBy("path").limit(limit) if limit else out


def with_metadata(files: DataFrame, root: str, categories: list = rules.CATEGORIES) -> DataFrame:
    """Adds the eight metadata fields of `files` (path, length, modificationTime in microseconds or a
    timestamp). A file right under `root` is its own project; outside of it all of the path counts."""
    root = root.rstrip("/") + "/"
    inside = F.when(F.col("path").startswith(root), F.substring("path", len(root) + 1, 1 << 20)).otherwise(F.regexp_replace("path", "^/+", ""))
    files = files.withColumn("_parts", F.split(inside, "/"))
    parts, n = F.col("_parts"), F.size("_parts")
    name = F.element_at(parts, -1)
    mtime = F.col("modificationTime")
    if dict(files.dtypes)["modificationTime"] == "bigint":
        mtime = F.timestamp_micros(mtime)
    return files.select(
        "*",
        F.col("path").alias("source_path"),
        name.alias("file_name"),
        text.suffix("path").alias("file_type"),
        F.coalesce("length", F.lit(0)).cast("long").alias("file_size"),
        text.project_name(F.element_at(parts, 1)).alias("project"),
        F.when(n > 2, F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), "/")).otherwise("").alias("sub_path"),
        text.year_in(parts, F.coalesce(F.year(mtime).cast("string"), F.lit("unknown"))).alias("year"),
        text.classified(F.array_join(parts, " "), categories).alias("category"),
    ).drop("_parts")


def with_outcome(docs: DataFrame, least: int = 10, supported: Column | None = None, characters: Column | None = None) -> DataFrame:
    """Adds status (success, skipped, failed) and reason. Unsupported files are skipped; texts that are null,
    or shorter than `least` characters without the space around them, fail. `characters` has that number where the text is not at hand."""
    short = F.coalesce((F.length(text.strip("text")) if characters is None else characters) < least, F.lit(True))
    skip = F.lit(False) if supported is None else ~supported
    return docs.withColumns({"status": F.when(skip, "skipped").when(short, "failed").otherwise("success"), "reason": F.when(skip, "unsupported").when(short, "empty or too short")})


def ingest_stats(outcomes: DataFrame) -> DataFrame:
    """One row of counters over rows with status and chunks."""
    of = lambda s: F.count_if(F.col("status") == s)
    out = outcomes.agg(F.count("*").alias("total"), of("success").alias("success"), of("failed").alias("failed"), of("skipped").alias("skipped"), F.coalesce(F.sum("chunks"), F.lit(0)).cast("long").alias("chunks"))
    rate = F.round(F.lit(100.0) * F.col("success") / F.greatest("total", F.lit(1)), 1)
    return out.withColumn("success_rate", F.concat(F.format_string("%.1f", rate), F.lit("%")))


def outcomes_by_extension(outcomes: DataFrame) -> DataFrame:
    """Counts by status overall (ext null) and by extension, in one pass over grouping sets."""
    return outcomes.groupingSets([["status"], ["ext", "status"]], "ext", "status").agg(F.count("*").alias("n"))


def failures(outcomes: DataFrame, by: Column, name: str) -> DataFrame:
    return outcomes.groupBy(by.alias(name)).agg(F.count("*").alias("n"))


def even_sample(files: DataFrame, most: int) -> DataFrame:
    """About `most` rows, as many of each extension: the first by path."""
    from pyspark.sql.window import Window

    kinds = max(1, files.select("ext").distinct().count())
    first = F.row_number().over(Window.partitionBy("ext").orderBy("path")) <= max(1, most // kinds)
    return files.withColumn("_first", first).where("_first").drop("_first").orderBy("path").limit(most)
