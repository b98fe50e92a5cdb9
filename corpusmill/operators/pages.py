"""Report pages as ordered lines and as files, one for each page, and their headers, whose unknown fields survive."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.place import opened_for
from . import requirements
from .tables import deleted, dropped, new_folder, placed, written

#: Bytes that are copied at a time.
_COPIED = 8 << 20


def write_pages(lines: DataFrame, folder: str, name: str = "name", order: list[str] = ["section", "place"], line: str = "line") -> DataFrame:  # noqa: B006
    """Writes for each `name` of `lines` the file `folder`/name, its lines in `order`, each with a line feed; returns name, lines and
    bytes of the files. A null line is an empty one.

    Lines are sorted by range over name and order, so a page with most of the rows is written by many tasks: each writes its run of
    a page to a file of its own, and what a page has of these is copied, in order and a few MB at a time, into the page, which then
    takes the place of an older one at once. A task that is run again writes other files, which are the ones that count."""
    spark = lines.sparkSession
    laid, work = placed(lines.select(name, *order, line), [name], order), new_folder(spark, "pages")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sink, last = [], None, (None, -1)
        for batch in batches:
            for page, at, body in zip(*(batch.column(c).to_pylist() for c in ("name", "at", "line")), strict=True):
                if (page, at - 1) != last:
                    if sink:
                        sink.close()
                    out.append([page, at, f"{work}/{uuid.uuid4().hex}", 0, 0])
                    fs, place = opened_for(out[-1][2])
                    fs.create_dir(place.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(place)
                data = f"{body or ''}\n".encode()
                sink.write(data)
                out[-1][3] += 1
                out[-1][4] += len(data)
                last = page, at
        if sink:
            sink.close()
        yield pa.RecordBatch.from_pylist([dict(zip(("name", "at", "file", "lines", "bytes"), x, strict=True)) for x in out], schema)

    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("file", pa.string()), ("lines", pa.int64()), ("bytes", pa.int64())])
    rows = laid.select(F.col(name).cast("string").alias("name"), F.col("_i").alias("at"), F.col(line).alias("line"))
    parts = written(rows.mapInArrow(runs, "name string, at long, file string, lines long, bytes long"))
    whole = parts.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("at", "file"))).alias("files"), F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, files in zip(batch.column("name").to_pylist(), batch.column("files").to_pylist(), strict=True):
                fs, target = opened_for(f"{folder}/{page}")
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                unfinished = f"{target}.{uuid.uuid4().hex}"
                with fs.open_output_stream(unfinished) as sink:
                    for part in files:
                        source, place = opened_for(part["file"])
                        with source.open_input_stream(place) as stream:
                            while data := stream.read(_COPIED):
                                sink.write(data)
                fs.move(unfinished, target)
            yield batch.select(["name", "lines", "bytes"])

    out = written(whole.repartition("name").mapInArrow(joined, "name string, lines long, bytes long"))
    dropped(laid, parts)
    deleted(spark, work)
    return out


def _as_one(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Parts of pages (name, line and their own order columns) as name, section, place, line. Within a part the place is a
    running number (`at`, if that is the order), so that all parts sort alike."""
    out = None
    for section, (rows, order) in enumerate(parts):
        if order == ["at"]:
            rows = rows.withColumn("place", F.col("at").cast("long"))
        elif order:
            rows = placed(rows, ["name"], order).select("name", "line", F.col("_i").alias("place"))
        else:
            rows = rows.withColumn("place", F.lit(0).cast("long"))
        rows = rows.select("name", F.lit(section).alias("section"), "place", "line")
        out = rows if out is None else out.unionByName(rows)
    return out


def _fixed(names: DataFrame, *lines: str) -> tuple[DataFrame, list[str]]:
    return names.select("name", F.posexplode(F.array(*map(F.lit, lines))).alias("at", "line")), ["at"]


def _cells(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), F.lit(" |"))


def _most_common(counts: DataFrame, by: str, shown: Column, n: int | None = None) -> DataFrame:
    """name, common: what is counted in `counts` (name, `by`, n), the most frequent first, ties by `by`."""
    every = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), shown.alias("shown"))))
    return counts.groupBy("name").agg(F.array_join(F.transform(F.slice(every, 1, n) if n else every, lambda x: x["shown"]), ", ").alias("common"))


def project_pages(items: DataFrame) -> DataFrame:
    """The lines of a page for each project of `items` (project_slug, project_title, source_file, pos, name, detail, type, strategy): counts, types by
    frequency, sources, and a table of all requirements with their running numbers. Pages are named <project_slug>.md."""
    rows = items.withColumnRenamed("name", "title").withColumn("name", F.concat("project_slug", F.lit(".md")))
    totals = written(rows.groupBy("name", "project_slug").agg(F.max("project_title").alias("project_title"), F.countDistinct("source_file").alias("files"), F.count("*").alias("n")))
    types = rows.groupBy("name", "type").agg(F.count("*").alias("n"))
    common = _most_common(types, "type", F.concat_ws(" ", "type", F.col("n").cast("string")))
    head = totals.select("name", F.posexplode(F.array(F.lit("---"), *[F.concat(F.lit(f"{label}: "), F.to_json(F.struct(F.col(c).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("v")))) - 6)) for label, c in (("project", "project_slug"), ("title", "project_title"), ("sources", "files"), ("requirements", "n"))], F.lit("---"), F.lit(""), F.concat(F.lit("# "), "project_title"), F.lit(""), F.concat(F.lit("- Sources: "), F.col("files").cast("string")), F.concat(F.lit("- Requirements: "), F.col("n").cast("string")))).alias("at", "line"))
    sources = rows.select("name", "source_file").distinct()
    table = placed(rows.select("name", "source_file", "pos", "title", "detail", "type", "strategy"), ["name"], ["source_file", "pos"])
    cells = [text.md_escape(F.col(c)) for c in ("title", "detail", "type", "strategy", "source_file")]
    table = table.select("name", F.col("_i").alias("at"), _cells(F.format_string("R-%03d", F.col("_i") + 1), *cells).alias("line"))
    return _as_one([
        (head, ["at"]), (common.select("name", F.concat(F.lit("- Types: "), "common").alias("line")), []), _fixed(totals, "", "## Sources", ""),
        (sources.select("name", "source_file", F.concat(F.lit("- `"), "source_file", F.lit("`")).alias("line")), ["source_file"]),
        _fixed(totals, "", "## Requirements", "", "| ID | Name | Requirement | Type | Strategy | Source |", "|---|---|---|---|---|---|"), (table, ["at"]),
    ])


def index_page(items: DataFrame, page: str = "index.md") -> DataFrame:
    """The lines of one page over all projects: totals, types by frequency, and a row for each project, the largest first."""
    rows = items.select(F.lit(page).alias("name"), "project_slug", "project_title", "source_file", "type")
    types = rows.groupBy("name", "type").agg(F.count("*").alias("n"))
    projects = rows.groupBy("name", "project_slug").agg(F.max("project_title").alias("project_title"), F.countDistinct("source_file").alias("files"), F.count("*").alias("n"))
    own = rows.groupBy(F.col("project_slug").alias("name"), "type").agg(F.count("*").alias("n"))
    top = _most_common(own, "type", F.concat(F.col("type"), F.lit("("), F.col("n").cast("string"), F.lit(")")), 3).withColumnRenamed("name", "project_slug")
    projects = written(projects.join(top, "project_slug", "left"))
    totals = projects.groupBy("name").agg(F.count("*").alias("projects"), F.sum("files").alias("files"), F.sum("n").alias("n"))
    head = totals.select("name", F.posexplode(F.array(F.lit("# Requirements"), F.lit(""), *[F.concat(F.lit(f"- {label}: "), F.col(c).cast("string")) for label, c in (("Projects", "projects"), ("Sources", "files"), ("Requirements", "n"))])).alias("at", "line"))
    names = totals.select("name")
    link = F.concat(F.lit("["), F.col("project_slug"), F.lit("](./"), F.col("project_slug"), F.lit(".md)"))
    return _as_one([
        (head, ["at"]), _fixed(names, "", "## Types", "", "| Type | Requirements |", "|---|---|"),
        (types.select("name", (-F.col("n")).alias("less"), "type", _cells(F.col("type"), F.col("n")).alias("line")), ["less", "type"]),
        _fixed(names, "", "## Projects", "", "| Project | Requirements | Types | Page |", "|---|---|---|---|"),
        (projects.select("name", (-F.col("n")).alias("less"), "project_slug", _cells(text.md_escape(F.col("project_title")), F.col("n"), F.col("common"), link).alias("line")), ["less", "project_slug"]),
    ])


def year_page(pages: DataFrame, page: str = "by-year.md") -> DataFrame:
    """The lines of one page over `pages` (id, title, period_start, period_end, file_count, formats as text): a part for each year that projects begin in,
    the last first and undated ones at the end, and in it the projects by begin and id."""
    year = F.coalesce(F.nullif(F.substring("period_start", 1, 4), F.lit("")), F.lit("undated"))
    rows = pages.select(F.lit(page).alias("name"), "*", year.alias("year"))
    span = F.concat_ws(" ~ ", F.coalesce(F.nullif("period_start", F.lit("")), F.lit("-")), F.nullif("period_end", F.lit("")))
    line = _cells(text.md_escape(F.col("title")), span, F.coalesce("file_count", F.lit(0)), F.col("formats"), F.concat(F.lit("["), "id", F.lit("](./"), "id", F.lit("/index.md)")))
    last, start = F.when(F.col("year") == "undated", F.lit(0)).otherwise(-F.col("year").cast("int")).alias("less"), F.coalesce(F.nullif("period_start", F.lit("")), F.lit("9999")).alias("start")
    undated = (F.col("year") == "undated").cast("int").alias("undated")
    body = rows.select("name", undated, last, F.lit(6).alias("k"), start, "id", line.alias("line"))
    years = rows.groupBy("name", "year").agg(F.count("*").alias("n"))
    tops = [F.lit(""), F.concat(F.lit("## "), F.initcap("year"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")), F.lit(""), F.lit("| Title | Period | Files | Formats | Page |"), F.lit("|---|---|---|---|---|")]
    tops = years.select("name", undated, last, F.lit("").alias("start"), F.lit("").alias("id"), F.posexplode(F.array(*tops)).alias("k", "line"))
    totals = rows.groupBy("name").agg(F.count("*").alias("n"), F.sum("file_count").alias("files"))
    head = totals.select("name", F.posexplode(F.array(F.lit("# Projects by year"), F.lit(""), F.concat(F.lit("- Projects: "), F.col("n").cast("string")), F.concat(F.lit("- Files: "), F.coalesce("files", F.lit(0)).cast("string")))).alias("at", "line"))
    every = body.unionByName(tops.select(*body.columns))
    return _as_one([(head, ["at"]), (every, ["undated", "less", "k", "start", "id"])])


def _fields(header: str | None) -> str:
    """A YAML header as a JSON object; {} for none. Without the library for it, lines of `key: JSON` are read."""
    try:
        import yaml
    except ImportError:
        yaml = None
    if yaml:  # the library's C parser, where it has one, reads the same fields several times as fast
        found = yaml.load(header or "", getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    else:
        found = {k.strip(): json.loads(v) for k, _, v in (x.partition(":") for x in (header or "").splitlines() if x.strip())}
    return json.dumps(found if isinstance(found, dict) else {}, ensure_ascii=False, default=str)


def with_fields(pages: DataFrame, header: str = "header") -> DataFrame:
    """Adds fields, the YAML `header` as a VARIANT object, so fields that nothing here knows are kept with their types. A header that cannot be
    read is an empty one, with the cause in header_error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(header).to_pylist():
                try:
                    out.append((_fields(x), None))
                except Exception as e:  # one page must not end the job
                    out.append(("{}", f"{type(e).__name__}: {e}"))
            columns = [*batch.columns, pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_json", "header_error"])

    none = F.lit(None).cast("string")
    read = pages.mapInArrow(run, pages.withColumns({"_json": none, "header_error": none}).schema)
    return read.withColumn("fields", F.parse_json("_json")).drop("_json")


def merged_fields(pages: DataFrame, new: DataFrame, forced: list[str], defaulted: list[str], key: str = "id") -> DataFrame:
    """key and fields: the fields of `pages` (key, fields: VARIANT) with the values of `forced` columns of `new`, and of `defaulted` ones where the page has no such
    field; all others stay as they are. A row for each of `new`; a null of `new` sets nothing."""
    every = F.variant_get(F.coalesce("_old", F.parse_json(F.lit("{}"))), "$", "map<string,variant>")
    put = lambda names: F.from_json(F.to_json(F.struct(*names)), "map<string,variant>")
    rows = new.join(pages.select(key, F.col("fields").alias("_old")), key, "left").withColumns({"_all": every, "_new": put(forced), "_more": put(defaulted)})
    kept = F.map_filter("_all", lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    known = F.map_concat("_new", kept)
    more = F.map_filter("_more", lambda k, _: ~F.array_contains(F.map_keys("_all"), k) & ~F.array_contains(F.map_keys("_new"), k))
    return rows.select(key, F.parse_json(F.to_json(F.map_concat(known, more))).alias("fields"))


def header_text(fields: Column, first: list[str]) -> Column:
    """A header of `key: JSON` lines between --- lines: the fields of `first` in this order, then the others by name."""
    pairs = F.map_entries(F.variant_get(fields, "$", "map<string,variant>"))
    place = lambda e: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, first)), e["key"]), F.lit(0)), F.lit(len(first) + 1))
    shown = F.array_sort(F.transform(pairs, lambda e: F.struct(place(e).alias("at"), e["key"].alias("key"), F.to_json(e["value"]).alias("value"))))
    return F.concat(F.lit("---\n"), F.array_join(F.transform(shown, lambda x: F.concat(x["key"], F.lit(": "), x["value"], F.lit("\n"))), ""), F.lit("---\n"))


def pattern_page(items: DataFrame, tagged: DataFrame, types: list[str], page: str = "patterns.md", thin: int = 6) -> DataFrame:
    """The lines of one page on what recurs: types with their shares in the order of `types`, themes by how many projects have them, each
    with its projects and best examples, and the first `thin` themes that have many requirements and few strategies. `tagged` has a row for
    each theme of an item (operators.requirements.with_themes)."""
    stats = written(requirements.theme_stats(tagged))
    named = lambda rows, *columns: rows.select(F.lit(page).alias("name"), *columns)
    totals = named(items.agg(F.count("*").alias("n")), "n").where("n > 0")
    head = totals.select("name", F.posexplode(F.array(F.lit("# Patterns"), F.lit(""), F.concat(F.lit("- Requirements: "), F.col("n").cast("string")))).alias("at", "line"))
    shares = requirements.type_distribution(items, types)
    shares = named(shares, "place", "type", _cells(F.col("type"), F.col("n"), F.concat(F.format_string("%.1f", "percent"), F.lit("%"))).alias("line"))
    ranked = named(stats, F.col("rank").alias("at"), _cells(F.col("rank"), F.col("theme"), F.col("projects"), F.col("n"), F.col("n_strategy")).alias("line"))
    rank = stats.select("theme", "rank", F.col("n").alias("of"))
    where = rank.join(requirements.theme_projects(tagged), "theme")
    tops = [F.lit(""), F.concat(F.lit("### "), F.col("theme"), F.lit(" ("), F.col("of").cast("string"), F.lit(")")), F.lit(""), F.concat(F.lit("- Projects: "), F.col("projects")), F.lit(""), F.lit("| Name | Requirement | Type | Strategy | Source |"), F.lit("|---|---|---|---|---|")]
    tops = named(where, "rank", F.posexplode(F.array(*tops)).alias("k", "line"))
    cut = lambda c, n: F.substring(text.md_escape(F.col(c)), 1, n)
    examples = requirements.theme_examples(tagged).join(rank, "theme")
    examples = named(examples, "rank", (F.col("place") + 6).alias("k"), _cells(text.md_escape(F.col("name")), cut("detail", 80), text.md_escape(F.col("type")), cut("strategy", 50), cut("source_file", 45)).alias("line"))
    few = requirements.thin_themes(stats).orderBy("rank").limit(thin)
    few = named(few, F.col("rank").alias("at"), F.concat(F.lit("- "), F.col("theme"), F.lit(": "), F.col("n_strategy").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" with a strategy")).alias("line"))
    return _as_one([
        (head, ["at"]), _fixed(totals, "", "## Types", "", "| Type | Requirements | Share |", "|---|---|---|"), (shares, ["place", "type"]),
        _fixed(totals, "", "## Themes", "", "| Rank | Theme | Projects | Requirements | With a strategy |", "|---|---|---|---|---|"), (ranked, ["at"]),
        (tops.unionByName(examples), ["rank", "k"]), _fixed(totals, "", "## Themes without strategies", ""), (few, ["at"]),
    ])


#: What a new page says until someone writes it.
DEFAULT_BODY = ["", "## Summary", "", "## Results", "", "-", "", "## Technology", "", "-", "", "## Reuse", "", "-", "", "## Files", "", "-"]


def generated(registry: DataFrame, counts: DataFrame, old: DataFrame, slug: str | None = None, body: list[str] = DEFAULT_BODY) -> DataFrame:  # noqa: B006
    """name, section, place and line of the pages of all projects of `registry` (slug, raw_name, title, period_start, period_end, is_yearly, domain), or of
    one (an unknown one is an error), that `counts` (raw_name, file_count, formats: map) has files of. A page that `old` (name, header, body) has keeps
    its body and its fields; the id, the folder and the counts are set anew, the rest only where it is missing. Yearly folders go to
    yearly/<year>.md, others to <slug>/index.md."""
    if slug is not None:
        registry = registry.where(F.col("slug") == slug)
        if registry.isEmpty():
            raise ValueError(f"no project {slug!r}")
    name = F.when(F.coalesce("is_yearly", F.lit(False)), F.concat(F.lit("yearly/"), F.substring(F.coalesce("period_start", "slug"), 1, 4), F.lit(".md"))).otherwise(F.concat("slug", F.lit("/index.md")))
    new = registry.join(counts, "raw_name").select(name.alias("name"), F.col("slug").alias("id"), F.coalesce("title", "slug").alias("title"), "period_start", "period_end", F.coalesce("domain", F.lit("etc")).alias("domain"), F.lit("completed").alias("status"), F.col("raw_name").alias("source_path"), "file_count", "formats")
    kept = with_fields(old)
    fields = merged_fields(kept.select("name", "fields"), new, ["id", "source_path", "file_count", "formats"], ["title", "period_start", "period_end", "domain", "status"], "name")
    first = ["id", "title", "period_start", "period_end", "domain", "status", "source_path", "file_count", "formats"]
    text_ = F.concat(header_text(F.col("fields"), first), F.coalesce(F.regexp_replace("body", r"\n\z", ""), F.lit("\n".join(body))))
    rows = fields.join(kept.select("name", "body"), "name", "left").select("name", F.posexplode(F.split(text_, "\n")).alias("place", "line"))
    return rows.select("name", F.lit(0).alias("section"), "place", "line")
