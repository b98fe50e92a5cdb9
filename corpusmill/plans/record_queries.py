"""Queries over manifests, requirement records and project pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import pages, reports, requirements
from ..operators.tables import deleted, new_folder, written
from .registry import FILES, ROOT, SPACE, files, query, strip_sql, table

_WORD, _INCLUDE, _PREFIX, _EXCLUDE, _FOLDERS = "ver", ["ver 1", "ver2"], "manual", ["meeting", "draft"], ["team", "1999"]


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = files(spark, sf_dir).withColumn("source_rel", F.substring("path", len(ROOT) + 2, 1 << 20))
    rel = rel.withColumn("parts", F.split("source_rel", "/")).withColumn("stem", text.stem(text.file_name("path")))
    return rel.select("doc_id", "source_rel", "parts", "stem", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


@query(f"""WITH {FILES} SELECT path FROM named WHERE name NOT LIKE '~$%' AND contains(name, 'ver') AND NOT contains(name, 'meeting') AND NOT contains(name, 'draft')
  AND NOT contains(substr(path, 1, length(path) - length(name)), 'team') AND NOT contains(substr(path, 1, length(path) - length(name)), '1999')
  AND (contains(name, 'ver 1') OR contains(name, 'ver2') OR starts_with(name, 'manual'))""")
def manifest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _manifest(spark, sf_dir)
    return rows.where(requirements.is_requirement_document(F.col("parts"), _WORD, _INCLUDE, _PREFIX, _EXCLUDE, _FOLDERS)).select(F.concat(F.lit(f"{ROOT}/"), F.col("source_rel")).alias("path"))


_STEM = f"WITH {FILES}, s AS (SELECT *, regexp_replace(name, '([^.])\\.[^./]+$', '\\1') AS stem FROM named)"
#: White space in this SQL, alone and within a class; written out, as the engine's own is ASCII only.
_S, _IN = SPACE, SPACE[1:-1]
_VERSION = rf"(?i)ver[.]?{_S}*([0-9]+(?:[.][0-9]+)*){_S}*([a-z]?)"
_KEY = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(split(stem, '(')[1],
  '{_VERSION}', '', 'g'), '(?i)[{_IN}_-]v[0-9][0-9]+', '', 'g'), '20[0-9]{{6}}|[0-9]{{6}}', '', 'g'), '[[][0-9]+[]]', '', 'g'), '[{_IN}_.-]+$', '', 'g'), '{_S}+', ' ', 'g'), ' -_.')"""


@query(f"{_STEM} SELECT doc_id, coalesce(nullif(lower({_KEY}), ''), lower(stem)) AS doc_key FROM s")
def doc_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).select("doc_id", text.doc_key("stem").alias("doc_key"))


_SCORED = f"""{_STEM}, v AS (SELECT *, regexp_extract(stem, '{_VERSION}', 1) AS num, lower(regexp_extract(stem, '{_VERSION}', 2)) AS letter,
  coalesce(nullif(regexp_extract(stem, '20[0-9]{{6}}|[0-9]{{6}}'), '')::INT, 0) AS date, coalesce(nullif(lower({_KEY}), ''), lower(stem)) AS doc_key FROM s
), w AS (SELECT *, CASE WHEN num = '' THEN [0::HUGEINT] WHEN letter = '' THEN split(num, '.')::HUGEINT[] ELSE list_append(split(num, '.')::HUGEINT[], ascii(letter) - 96) END AS version FROM v)"""


@query(f"{_SCORED} SELECT doc_id, array_to_string(version, '.') AS version, date FROM w")
def version_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _manifest(spark, sf_dir)
    return rows.select("doc_id", F.array_join(F.transform(text.version_numbers("stem"), lambda x: x["number"]), ".").alias("version"), text.version_date("stem").alias("date"))


@query(f"""{_SCORED}, g AS (SELECT *, split(split(path, '/')[4], ' ')[5] AS slug FROM w),
r AS (SELECT doc_id, slug, doc_key, row_number() OVER (PARTITION BY slug, split(doc_key, '_')[1] ORDER BY version DESC, date DESC, mtime DESC, length DESC, path) AS k FROM g)
SELECT doc_id, k = 1 AS is_primary FROM r""")
def manifest_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _manifest(spark, sf_dir).select("doc_id", "source_rel", "size", "mtime", text.version_numbers("stem").alias("version"), text.version_date("stem").alias("date"), F.split(F.col("parts")[1], " ")[4].alias("project_slug"), F.substring_index(text.doc_key("stem"), "_", 1).alias("doc_key"))
    return requirements.primary(rows).select("doc_id", "is_primary")


@query(f"{_STEM} SELECT count(DISTINCT split(path, '/')[3]) AS projects, count(*) AS n, ext FROM s GROUP BY ext")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _manifest(spark, sf_dir).select(F.col("parts")[0].alias("project"), text.suffix("source_rel").alias("ext"))
    return rows.groupBy("ext").agg(F.countDistinct("project").alias("projects"), F.count("*").alias("n"))


def _slug_sql(x: str) -> str:
    return f"coalesce(nullif(lower(regexp_replace(regexp_replace(regexp_replace({strip_sql(x)}, '[{_IN}_]+', '-', 'g'), '[^0-9A-Za-z가-힣-]', '', 'g'), '^-+|-+$', '', 'g')), ''), 'unknown')"


@query(f"WITH {FILES} SELECT doc_id, {_slug_sql('name')} AS slug FROM named")
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(spark, sf_dir).select("doc_id", text.slugify(text.file_name("path")).alias("slug"))


_PERIOD = rf"^[(]([0-9]{{4}})[.]([0-9]{{1,2}}){_S}*-{_S}*([0-9]{{4}})[.]([0-9]{{1,2}})[)]{_S}*(.+)$"
_FOLDER = f"""WITH {FILES}, f AS (SELECT DISTINCT unnest([split(path, '/')[3], split(path, '/')[4]]) AS folder FROM named),
p AS (SELECT *, regexp_extract(folder, '{_PERIOD}', 1) AS y1, regexp_extract(folder, '{_PERIOD}', 2) AS m1, regexp_extract(folder, '{_PERIOD}', 3) AS y2, regexp_extract(folder, '{_PERIOD}', 4) AS m2,
  {strip_sql(f"regexp_extract(folder, '{_PERIOD}', 5)")} AS t, regexp_extract(folder, '^(\\d{{4}})년$', 1) AS y FROM f)"""


def _folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.split("path", "/")
    return files(spark, sf_dir).select(F.explode(F.array(parts[2], parts[3])).alias("folder")).distinct()


@query(f"""{_FOLDER} SELECT folder, CASE WHEN y1 <> '' THEN y1 || '-' || lpad(m1, 2, '0') END AS period_start, CASE WHEN y1 <> '' THEN y2 || '-' || lpad(m2, 2, '0') END AS period_end,
  CASE WHEN y1 <> '' THEN t ELSE folder END AS title, y1 = '' AND y <> '' AS is_yearly, CASE WHEN y1 = '' AND y <> '' THEN y END AS yearly FROM p""")
def parse_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folders(spark, sf_dir).select("folder", text.folder_fields("folder").alias("f")).select("folder", "f.*")


@query(f"""{_FOLDER}, s AS (SELECT *, lower(regexp_replace(trim(regexp_replace(CASE WHEN y1 <> '' THEN t ELSE folder END, '[^A-Za-z0-9_\\s-]', '', 'g')), '\\s+', '-', 'g')) AS s FROM p)
SELECT folder, CASE WHEN y1 = '' AND y <> '' THEN 'yearly-' || y WHEN y1 <> '' AND s <> '' THEN y1 || '-' || s WHEN y1 <> '' THEN y1 WHEN s = '' THEN 'untitled' ELSE s END AS slug FROM s""")
def auto_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folders(spark, sf_dir).select("folder", text.auto_slug("folder").alias("slug"))


@query(f"""WITH {FILES}, r AS (SELECT 'Portal Renewal' AS raw_name, 'portal' AS slug, 'The portal' AS title, false AS is_yearly UNION ALL SELECT 'plan 1987 to 2031', 'plans', 'Plans', true),
j AS (SELECT n.*, r.*, split(path, '/')[3] AS top, split(path, '/')[4] AS sub, regexp_extract(split(path, '/')[4], '{_PERIOD}', 1) AS y, {strip_sql(f"regexp_extract(split(path, '/')[4], '{_PERIOD}', 5)")} AS t FROM named n LEFT JOIN r ON raw_name = split(path, '/')[3])
SELECT doc_id, CASE WHEN slug IS NOT NULL AND NOT is_yearly THEN slug WHEN coalesce(is_yearly, false) OR regexp_matches(top, '^\\d{{4}}년') THEN y || '-' || {_slug_sql('t')} ELSE {_slug_sql('top')} END AS project_slug,
  CASE WHEN slug IS NOT NULL AND NOT is_yearly THEN title WHEN coalesce(is_yearly, false) OR regexp_matches(top, '^\\d{{4}}년') THEN t ELSE top END AS project_title FROM j""")
def resolve_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    slugs = spark.createDataFrame([("Portal Renewal", "portal", "The portal", False), ("plan 1987 to 2031", "plans", "Plans", True)], "raw_name string, slug string, title string, is_yearly boolean")
    return requirements.with_project(_manifest(spark, sf_dir).select("doc_id", "parts"), slugs).select("doc_id", "project_slug", "project_title")


@query("SELECT r.r_regionkey AS key, count(*) AS n, coalesce(any_value(r_name), 'etc') AS domain FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey AND r.r_regionkey <> 3 GROUP BY 1")
def domain_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = table(spark, sf_dir, "region").where("r_regionkey <> 3")
    rows = table(spark, sf_dir, "nation").join(domains, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return rows.groupBy(F.col("r_regionkey").alias("key")).agg(F.count("*").alias("n"), F.coalesce(F.first("r_name", ignorenulls=True), F.lit("etc")).alias("domain"))


_KINDS = {"user": "기능", "assistant": "데이터", "system": "system"}
_ITEMS = """WITH items AS (SELECT 'project-' || (conv_id % 12)::VARCHAR AS project_slug, 'Project ' || (conv_id % 12)::VARCHAR AS project_title, 'file ' || conv_id::VARCHAR || '.json' AS source_file,
  (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, substr(text, 1, 20) AS name, text AS detail,
  CASE role WHEN 'user' THEN '기능' WHEN 'assistant' THEN '데이터' ELSE '기타' END AS type, CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN 'plan ' || turn::VARCHAR ELSE '(원문 미기재)' END AS strategy FROM conversations)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for p in _KINDS.items() for x in p])[F.col("role")]
    strategy = F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, F.concat(F.lit("plan "), F.col("turn").cast("string"))).otherwise(rules.NO_STRATEGY)
    turn = F.struct("turn", F.substring("text", 1, 20).alias("name"), F.col("text").alias("detail"), kind.alias("type"), strategy.alias("strategy"))
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("requirements"))
    project = (F.col("conv_id") % 12).cast("string")
    docs = docs.select(F.concat(F.lit("project-"), project).alias("project_slug"), F.concat(F.lit("Project "), project).alias("project_title"), F.concat(F.lit("file "), F.col("conv_id").cast("string"), F.lit(".json")).alias("source_file"), "requirements")
    return requirements.items(docs).drop("turn").withColumn("type", requirements.valid_type("type"))


@query(f"{_ITEMS} SELECT project_slug, source_file, pos, name, detail, type, strategy FROM items")
def requirements_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).drop("project_title")


@query(f"{_ITEMS} SELECT project_slug, source_file, pos, printf('R-%03d', row_number() OVER (PARTITION BY project_slug ORDER BY source_file, pos)) AS req_id FROM items")
def requirement_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.running_ids(_items(spark, sf_dir)).select("project_slug", "source_file", "pos", "req_id")


@query(f"""{_ITEMS} SELECT project_slug || '#R-' || printf('%03d', pos + 1) || '__' || replace(source_file, '.json', '') AS chunk_id,
  '[' || project_title || '] ' || name || ' — ' || detail || ' (' || type || ')' || CASE WHEN strategy NOT IN ('', '(원문 미기재)') THEN chr(10) || '[strategy] ' || strategy ELSE '' END AS text,
  regexp_extract(project_slug || ' ' || source_file, '19\\d{{2}}|20\\d{{2}}') AS year FROM items""")
def requirement_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.synthesized(_items(spark, sf_dir))


@query(f"{_ITEMS} SELECT type, count(*) AS n FROM items GROUP BY type")
def enum_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("type").agg(F.count("*").alias("n"))


@query("SELECT event_id, (props::JSON->>'k')::INT AS k FROM events")
def json_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    dress = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("Here it is: "), F.col("props"), F.lit(" as asked"))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", text.json_payload(dress, "k int")["k"].alias("k"))


@query(f"{_ITEMS} SELECT project_slug, type, count(*) AS n FROM items GROUP BY ROLLUP (project_slug, type)")
def type_counts_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.type_rollup(_items(spark, sf_dir))


@query(f"{_ITEMS} SELECT type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM items), 1) AS percent, list_position(['" + "', '".join(rules.REQUIREMENT_TYPES) + "'], type)::INT AS place FROM items GROUP BY type")
def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.type_distribution(_items(spark, sf_dir), rules.REQUIREMENT_TYPES)


_THEMES = " UNION ALL ".join(f"SELECT *, '{label}' AS theme FROM items WHERE {' OR '.join(f'contains(lower(detail), {w!r})' for w in words)}" for label, words in rules.ENGLISH_THEMES)
_TAGGED = f"""{_ITEMS}, tagged AS ({_THEMES}), stats AS (SELECT theme, count(*) AS n, count(DISTINCT project_slug) AS projects, count(*) FILTER (strategy NOT IN ('', '(원문 미기재)')) AS n_strategy FROM tagged GROUP BY theme)"""


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.with_themes(_items(spark, sf_dir), F.col("detail"), rules.ENGLISH_THEMES)


@query(f"{_TAGGED} SELECT theme, n, projects, n_strategy::BIGINT AS n_strategy, (row_number() OVER (ORDER BY projects DESC, n DESC, theme))::INT AS rank FROM stats")
def themes_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.theme_stats(_tagged(spark, sf_dir))


@query(f"{_TAGGED} SELECT theme, n FROM stats WHERE n >= 20 AND n_strategy < n * 0.4")
def thin_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.thin_themes(requirements.theme_stats(_tagged(spark, sf_dir)), 20, 0.4).select("theme", "n")


@query(f"""{_TAGGED}, r AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY strategy NOT IN ('', '(원문 미기재)') DESC, length(detail) DESC, source_file, pos) AS place FROM tagged)
SELECT theme, source_file, pos, place::INT AS place FROM r WHERE place <= 5""")
def theme_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.theme_examples(_tagged(spark, sf_dir)).select("theme", "source_file", "pos", "place")


@query(f"""{_TAGGED}, names AS (SELECT theme, list_sort(list(DISTINCT project_slug)) AS p FROM tagged GROUP BY theme)
SELECT theme, array_to_string(p[1:8], ', ') || CASE WHEN len(p) > 8 THEN ' + ' || (len(p) - 8)::VARCHAR || ' more' ELSE '' END AS projects FROM names""")
def theme_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requirements.theme_projects(_tagged(spark, sf_dir))


_TRACKED = ", ".join(f"'{e}'" for e in rules.TRACKED_EXTENSIONS)
_COUNTS = f"""WITH {FILES}, e AS (SELECT split(path, '/')[3] || ' ' || (doc_id % 40)::VARCHAR AS project, ext, count(*) AS n FROM named GROUP BY ALL),
c AS (SELECT project, sum(n)::BIGINT AS file_count, list_sort(list(struct_pack(ext, n)) FILTER (ext IN ({_TRACKED}))) AS f FROM e GROUP BY project)"""


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    project = F.concat(F.split("path", "/")[2], F.lit(" "), (F.col("doc_id") % 40).cast("string"))
    return reports.format_counts(files(spark, sf_dir).select(project.alias("project"), text.suffix("path").alias("ext")))


@query(f"{_COUNTS} SELECT project, file_count, coalesce(array_to_string(list_transform(f, lambda x: x.ext || ':' || x.n::VARCHAR), ', '), '') AS formats FROM c")
def format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(spark, sf_dir).select("project", "file_count", F.array_join(F.transform("formats", lambda x: F.concat(x["ext"], F.lit(":"), x["n"].cast("string"))), ", ").alias("formats"))


@query(f"{_COUNTS} SELECT project, coalesce(array_to_string(list_transform(list_sort(list_transform(f, lambda x: struct_pack(n := -x.n, ext := x.ext)))[1:3], lambda x: x.ext || ':' || (-x.n)::VARCHAR), ', '), '') AS top FROM c")
def top_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(spark, sf_dir).select("project", reports.top_formats().alias("top"))


@query(f"""{_COUNTS}, y AS (SELECT CASE WHEN project LIKE '(%' THEN substr(project, 2, 4) ELSE 'undated' END AS year, file_count FROM c)
SELECT year, count(*) AS projects, sum(file_count)::BIGINT AS files FROM y GROUP BY year""")
def projects_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.by_year(_counted(spark, sf_dir).withColumn("period_start", text.folder_fields("project")["period_start"]))


@query(f"""{_ITEMS}, r AS (SELECT *, row_number() OVER (PARTITION BY project_slug ORDER BY source_file, pos) AS k, trim(replace(replace(name, '|', chr(92) || '|'), chr(10), ' ')) AS cell FROM items)
SELECT project_slug, (k + 2)::INT AS place, '| ' || source_file || ' | ' || cell || ' | ' || type || ' |' AS line FROM r
UNION ALL SELECT DISTINCT project_slug, 1, '| File | Name | Type |' FROM items UNION ALL SELECT DISTINCT project_slug, 2, '|---|---|---|' FROM items""")
def project_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_lines(_items(spark, sf_dir), ["project_slug"], ["source_file", "pos"], ["source_file", "name", "type"], ["File", "Name", "Type"])


_HOT = _ITEMS.replace("'project-' || (conv_id % 12)::VARCHAR AS project_slug", "CASE WHEN conv_id % 10 > 0 THEN 'project-hot' ELSE 'project-' || (conv_id % 12)::VARCHAR END AS project_slug").replace("'Project ' || (conv_id % 12)::VARCHAR AS project_title", "CASE WHEN conv_id % 10 > 0 THEN 'Project hot' ELSE 'Project ' || (conv_id % 12)::VARCHAR END AS project_title")


def _hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items, nine conversations of ten in one project."""
    hot = F.regexp_extract("source_file", "([0-9]+)", 1).cast("long") % 10 > 0
    return _items(spark, sf_dir).withColumns({"project_slug": F.when(hot, "project-hot").otherwise(F.col("project_slug")), "project_title": F.when(hot, "Project hot").otherwise(F.col("project_title"))})


def _as_files(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Lines as pages on disk, and what is then read from there."""
    top = new_folder(spark)
    pages.write_pages(lines, top)
    out = written(spark.read.option("recursiveFileLookup", True).text(top, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text")))
    deleted(spark, top)
    return out


def _esc(x: str) -> str:
    return strip_sql(f"replace(replace(coalesce({x}, ''), '|', chr(92) || '|'), chr(10), ' ')")


@query(f"""{_HOT}, rows AS (SELECT *, project_slug || '.md' AS page, row_number() OVER (PARTITION BY project_slug ORDER BY source_file, pos) AS k FROM items
), totals AS (SELECT page, max(project_slug) AS slug, max(project_title) AS title, count(DISTINCT source_file) AS files, count(*) AS n FROM rows GROUP BY page
), types AS (SELECT page, string_agg(type || ' ' || n, ', ' ORDER BY n DESC, type || ' ' || n) AS types FROM (SELECT page, type, count(*) AS n FROM rows GROUP BY ALL) GROUP BY page
), sources AS (SELECT page, string_agg('- `' || source_file || '`', chr(10) ORDER BY source_file) AS sources FROM (SELECT DISTINCT page, source_file FROM rows) GROUP BY page
), tables AS (SELECT page, string_agg('| ' || printf('R-%03d', k) || ' | ' || {_esc('name')} || ' | ' || {_esc('detail')} || ' | ' || {_esc('type')} || ' | ' || {_esc('strategy')} || ' | ' || {_esc('source_file')} || ' |', chr(10) ORDER BY k) AS body FROM rows GROUP BY page)
SELECT page AS name, concat_ws(chr(10), '---', 'project: "' || slug || '"', 'title: "' || title || '"', 'sources: ' || files, 'requirements: ' || n, '---', '', '# ' || title, '', '- Sources: ' || files, '- Requirements: ' || n, '- Types: ' || types,
  '', '## Sources', '', sources, '', '## Requirements', '', '| ID | Name | Requirement | Type | Strategy | Source |', '|---|---|---|---|---|---|', body, '') AS text FROM totals JOIN types USING (page) JOIN sources USING (page) JOIN tables USING (page)""")
def project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_files(spark, pages.project_pages(_hot_items(spark, sf_dir)))


@query(f"""{_HOT}, types AS (SELECT type, count(*) AS n FROM items GROUP BY type
), own AS (SELECT project_slug, type || '(' || count(*) || ')' AS shown, count(*) AS n FROM items GROUP BY project_slug, type
), best AS (SELECT project_slug, string_agg(shown, ', ' ORDER BY n DESC, shown) AS top FROM (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY project_slug ORDER BY n DESC, shown) <= 3) GROUP BY project_slug
), projects AS (SELECT project_slug, max(project_title) AS title, count(DISTINCT source_file) AS files, count(*) AS n FROM items GROUP BY project_slug)
SELECT 'index.md' AS name, concat_ws(chr(10), '# Requirements', '', (SELECT '- Projects: ' || count(*) FROM projects), (SELECT '- Sources: ' || sum(files) FROM projects), (SELECT '- Requirements: ' || sum(n) FROM projects), '', '## Types', '', '| Type | Requirements |', '|---|---|',
  (SELECT string_agg('| ' || type || ' | ' || n || ' |', chr(10) ORDER BY n DESC, type) FROM types), '', '## Projects', '', '| Project | Requirements | Types | Page |', '|---|---|---|---|',
  (SELECT string_agg('| ' || title || ' | ' || n || ' | ' || top || ' | [' || project_slug || '](./' || project_slug || '.md) |', chr(10) ORDER BY n DESC, project_slug) FROM projects JOIN best USING (project_slug)), '') AS text""")
def index_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_files(spark, pages.index_page(_hot_items(spark, sf_dir)))


@query(f"""{_COUNTS}, p AS (SELECT *, regexp_extract(project, '{_PERIOD}', 1) AS y1, regexp_extract(project, '{_PERIOD}', 2) AS m1, regexp_extract(project, '{_PERIOD}', 3) AS y2, regexp_extract(project, '{_PERIOD}', 4) AS m2, {strip_sql(f"regexp_extract(project, '{_PERIOD}', 5)")} AS t FROM c
), q AS (SELECT *, CASE WHEN y1 <> '' THEN y1 || '-' || lpad(m1, 2, '0') END AS a, CASE WHEN y1 <> '' THEN y2 || '-' || lpad(m2, 2, '0') END AS b, CASE WHEN y1 <> '' THEN t ELSE project END AS title, CASE WHEN y1 <> '' THEN y1 ELSE 'undated' END AS year,
  coalesce(array_to_string(list_transform(list_sort(list_transform(f, lambda x: struct_pack(n := -x.n, ext := x.ext)))[1:3], lambda x: x.ext || ':' || (-x.n)::VARCHAR), ', '), '') AS formats FROM p
), y AS (SELECT year, concat_ws(chr(10), '', '## ' || CASE year WHEN 'undated' THEN 'Undated' ELSE year END || ' (' || count(*) || ')', '', '| Title | Period | Files | Formats | Page |', '|---|---|---|---|---|',
  string_agg('| ' || {_esc('title')} || ' | ' || coalesce(a, '-') || coalesce(' ~ ' || b, '') || ' | ' || file_count || ' | ' || formats || ' | [' || project || '](./' || project || '/index.md) |', chr(10) ORDER BY coalesce(a, '9999'), project)) AS body FROM q GROUP BY year)
SELECT 'by-year.md' AS name, concat_ws(chr(10), '# Projects by year', '', (SELECT '- Projects: ' || count(*) FROM q), (SELECT '- Files: ' || sum(file_count) FROM q), (SELECT string_agg(body, chr(10) ORDER BY year = 'undated', year DESC) FROM y), '') AS text""")
def year_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _counted(spark, sf_dir).withColumn("f", text.folder_fields("project"))
    rows = rows.select(F.col("project").alias("id"), F.col("f.title").alias("title"), F.col("f.period_start").alias("period_start"), F.col("f.period_end").alias("period_end"), "file_count", reports.top_formats().alias("formats"))
    return _as_files(spark, pages.year_page(rows))


@query(f"""{_TAGGED}, kinds AS (SELECT type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM items), 1) AS percent, list_position(['{"', '".join(rules.REQUIREMENT_TYPES)}'], type) AS place FROM items GROUP BY type
), ranked AS (SELECT *, row_number() OVER (ORDER BY projects DESC, n DESC, theme) AS rank FROM stats
), names AS (SELECT theme, list_sort(list(DISTINCT project_slug)) AS p FROM tagged GROUP BY theme
), best AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY strategy NOT IN ('', '(원문 미기재)') DESC, length(detail) DESC, source_file, pos) AS place FROM tagged QUALIFY place <= 5
), shown AS (SELECT theme, string_agg('| ' || {_esc('name')} || ' | ' || substr({_esc('detail')}, 1, 80) || ' | ' || {_esc('type')} || ' | ' || substr({_esc('strategy')}, 1, 50) || ' | ' || substr({_esc('source_file')}, 1, 45) || ' |', chr(10) ORDER BY place) AS rows FROM best GROUP BY theme
), parts AS (SELECT rank, concat_ws(chr(10), '', '### ' || theme || ' (' || n || ')', '', '- Projects: ' || array_to_string(p[1:8], ', ') || CASE WHEN len(p) > 8 THEN ' + ' || (len(p) - 8) || ' more' ELSE '' END, '', '| Name | Requirement | Type | Strategy | Source |', '|---|---|---|---|---|', rows) AS part
  FROM ranked JOIN names USING (theme) JOIN shown USING (theme)
), few AS (SELECT * FROM ranked WHERE n >= 20 AND n_strategy < n * 0.1 ORDER BY rank LIMIT 6)
SELECT 'patterns.md' AS name, concat_ws(chr(10), '# Patterns', '', (SELECT '- Requirements: ' || count(*) FROM items), '', '## Types', '', '| Type | Requirements | Share |', '|---|---|---|',
  (SELECT string_agg('| ' || type || ' | ' || n || ' | ' || printf('%.1f', percent) || '% |', chr(10) ORDER BY place, type) FROM kinds), '', '## Themes', '', '| Rank | Theme | Projects | Requirements | With a strategy |', '|---|---|---|---|---|',
  (SELECT string_agg('| ' || rank || ' | ' || theme || ' | ' || projects || ' | ' || n || ' | ' || n_strategy || ' |', chr(10) ORDER BY rank) FROM ranked), (SELECT string_agg(part, chr(10) ORDER BY rank) FROM parts),
  '', '## Themes without strategies', '', (SELECT string_agg('- ' || theme || ': ' || n_strategy || ' of ' || n || ' with a strategy', chr(10) ORDER BY rank) FROM few), '') AS text""")
def pattern_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_files(spark, pages.pattern_page(_items(spark, sf_dir), _tagged(spark, sf_dir), rules.REQUIREMENT_TYPES))


@query("""SELECT p_partkey AS id, p_name AS title, p_size AS file_count, CASE WHEN p_partkey % 3 = 0 THEN 'kept' ELSE 'new' END AS status, CASE WHEN p_partkey % 4 = 0 THEN 'note ' || p_partkey END AS note, CASE WHEN p_partkey % 4 = 0 THEN p_partkey * 2 END AS depth FROM part""")
def page_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as projects with pages whose YAML headers have fields of their own: forced ones are set anew, defaulted ones only where they are
    missing, and what nothing here knows of survives."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_size").alias("file_count"))
    own = F.when(F.col("id") % 4 == 0, F.concat(F.lit("note: note "), F.col("id").cast("string"), F.lit("\nmore:\n  depth: "), (F.col("id") * 2).cast("string"), F.lit("\n  list: [1, two]"))).otherwise("")
    status = F.when(F.col("id") % 3 == 0, "status: kept\n").otherwise("")
    old = part.where("id % 5 <> 1").select("id", F.concat(F.lit("file_count: -1\n"), status, own).alias("header")).unionByName(part.where("id % 5 = 1").select("id", F.concat(status, own).alias("header")))
    new = part.withColumn("status", F.lit("new"))
    fields = pages.merged_fields(pages.with_fields(old), new, ["title", "file_count"], ["status"])
    get = lambda path, kind: F.try_variant_get("fields", path, kind)
    return fields.select("id", get("$.title", "string").alias("title"), get("$.file_count", "int").alias("file_count"), get("$.status", "string").alias("status"), get("$.note", "string").alias("note"), get("$.more.depth", "long").alias("depth"))
