"""Files, tables of files, and their conversion to text by extension."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import partial
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators.tables import give_back, small_batches, written
from .compound import Compound, Damaged
from .place import opened_for

Converter = Callable[[bytes], str]


def scan(spark: SparkSession, root: str, extensions: list[str] = rules.TARGET_EXTENSIONS, content: bool = False) -> DataFrame:
    """path, modificationTime, length (and content, which is read only if asked for) of the files below `root`
    with these extensions, in any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    columns = ["path", "modificationTime", "length", *(["content"] if content else [])]
    return files.withColumn("ext", text.suffix("path")).where(F.col("ext").isin(extensions)).select(*columns, "ext")


def scan_by_tasks(spark: SparkSession, root: str, extensions: list[str] = rules.TARGET_EXTENSIONS) -> DataFrame:
    """The rows of `scan`, without content, where Arrow can open `root`: each level of folders is listed by tasks and written, so the
    driver sees no names, however many files there are."""

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                fs, place = opened_for(folder)
                before = folder.removesuffix(place) if "://" in folder and not folder.startswith("file:") else "file:"
                held = [x for x in fs.get_file_info(FileSelector(place, allow_not_found=True)) if x.base_name[:1] not in "._"]
                columns = [[before + x.path for x in held], [x.mtime for x in held], [x.size for x in held], [x.type == FileType.Directory for x in held]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "modificationTime", "length", "is_folder"])

    types = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.bool_()]
    tasks, levels = int(spark.conf.get("spark.sql.shuffle.partitions")), []
    folders = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    while not levels or not folders.isEmpty():
        levels.append(written(folders.repartition(tasks if levels else 1).mapInArrow(below, "path string, modificationTime timestamp, length long, is_folder boolean")))
        folders = levels[-1].where("is_folder").select("path")
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    files = files.where("NOT is_folder AND length > 0").withColumn("ext", text.suffix("path"))
    return files.where(F.col("ext").isin(extensions)).select("path", "modificationTime", "length", "ext")


def write_texts(rows: DataFrame, folder: str, key: str, value: str, a_folder: int = 1000) -> int:
    """Writes each row's `value` and a line feed as a file of its own, <task>/<number>/<row>-<key>=<its key>.txt below `folder`, `a_folder` files in a
    folder, and returns how many; null is an empty text. A task that is run again replaces its own files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, task = 0, TaskContext.get().partitionId()
        fs, top = opened_for(folder)
        for batch in batches:
            for name, body in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist(), strict=True):
                place = f"{top}/{task}/{n // a_folder}"
                if n % a_folder == 0:
                    fs.create_dir(place, recursive=True)
                with fs.open_output_stream(f"{place}/{n}-{key}={'' if name is None else name}.txt") as sink:
                    sink.write(f"{body or ''}\n".encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    made = rows.select(F.col(key).alias("key"), F.col(value).alias("value")).mapInArrow(run, "n long")
    return made.agg(F.sum("n")).first()[0] or 0


def delete_folders(folders: DataFrame) -> None:
    """Deletes the folders of `folders` (path) with what is in them, each by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                fs, place = opened_for(folder)
                if fs.get_file_info(place).type == FileType.Directory:
                    fs.delete_dir(place)
            yield batch

    folders.select("path").mapInArrow(run, "path string").count()


def top_folders(files: DataFrame, root: str) -> DataFrame:
    """The folders right below `root` that hold any of `files` (path), by name, with the number of files."""
    inside = F.split(F.substring("path", len(root.rstrip("/")) + 2, 1 << 20), "/")
    return files.where(F.size(inside) > 1).groupBy(inside[0].alias("folder")).agg(F.count("*").alias("files")).orderBy("folder")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = "project_slug string, project_title string, file_name string, ext string, size long, doc_key string, is_primary string, source_rel string, abs_path string"
    return spark.read.schema(schema).option("header", True).csv(path)


def extractions(spark: SparkSession, path: str) -> DataFrame:
    schema = "project_slug string, project_title string, domain string, source_file string, source_rel string, requirements array<struct<req_name: string, req_detail: string, req_type: string, strategy: string, source_loc: string>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))


def front_matters(spark: SparkSession, *paths: str) -> DataFrame:
    """path, header (the YAML text between the first two --- lines) and body of Markdown files with one."""
    pages = None
    for p in paths:
        part = spark.read.text(p, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
        pages = part if pages is None else pages.unionByName(part)
    cut = F.split("value", r"(?m)^---[ \t]*\r?\n", 3)
    return pages.where(F.size(cut) == 3).select("path", cut[1].alias("header"), cut[2].alias("body")).where(text.strip("header") != "")


def slug_registry(spark: SparkSession, projects: dict[str, dict]) -> DataFrame:
    """raw_name and the other fields of a YAML registry's `projects`, as a small table."""
    rows = [(slug, m.get("raw_name"), m.get("title"), m.get("period_start"), m.get("period_end"), bool(m.get("is_yearly")), m.get("domain")) for slug, m in projects.items()]
    return spark.createDataFrame(rows, "slug string, raw_name string, title string, period_start string, period_end string, is_yearly boolean, domain string")


def plain_text(data: bytes) -> str:
    """UTF-8, else the first of the Korean code pages or UTF-16 that fits, else Latin-1; lines end with \\n."""
    for code in ("utf-8", "cp949", "euc-kr", "utf-16", "latin-1"):
        try:
            return re.sub("\r\n?", "\n", data.decode(code))
        except UnicodeDecodeError:
            continue
    raise AssertionError


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(archive.read(name))


def _local(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _joined(e: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in e.iter() if _local(t) == "t")


def _rows(table: ElementTree.Element, between: str = "\t", merged: bool = False) -> list[str]:
    """A table's rows; `merged` takes a cell once that repeats the one before it, as merged cells do."""
    cells = [[" ".join(_joined(c).split()) for c in row if _local(c) == "tc"] for row in table.iter() if _local(row) == "tr"]
    if merged:
        cells = [[c for k, c in enumerate(row) if not k or c != row[k - 1]] for row in cells]
    return [between.join(c for c in row if c) for row in cells if any(row)]


def docx(data: bytes, title: str | None = None, between: str = "\t") -> str:
    """Paragraphs with text, then the rows of tables. `title`, with {n}, heads each table and has merged cells once."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = _xml(z, "word/document.xml")[0]
    lines = [s for p in body if _local(p) == "p" and (s := _joined(p).strip())]
    for n, table in enumerate((t for t in body if _local(t) == "tbl"), 1):
        rows = _rows(table, between, title is not None)
        lines += [title.format(n=n), *rows] if title and rows else rows
    return "\n".join(lines)


def pptx(data: bytes) -> str:
    """For each slide with text its number, and its paragraphs."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        numbers = sorted(int(m[1]) for n in z.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
        for n in numbers:
            lines = [s for p in _xml(z, f"ppt/slides/slide{n}.xml").iter() if _local(p) == "p" and (s := _joined(p).strip())]
            out += [f"[Slide {n}]", *lines] if lines else []
    return "\n".join(out)


def xlsx(data: bytes) -> str:
    """For each sheet with rows its name, and the rows' values (of formulas the last result), joined by tabs."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [_joined(s) for s in _xml(z, "xl/sharedStrings.xml") if _local(s) == "si"] if "xl/sharedStrings.xml" in z.namelist() else []
        sheets = [e.get("name") for e in _xml(z, "xl/workbook.xml").iter() if _local(e) == "sheet"]
        for n, name in enumerate(sheets, 1):
            rows = []
            for row in (r for r in _xml(z, f"xl/worksheets/sheet{n}.xml").iter() if _local(r) == "row"):
                values = []
                for c in row:
                    v = next((x.text for x in c if _local(x) == "v"), None)
                    v = _joined(c) if c.get("t") == "inlineStr" else shared[int(v)] if c.get("t") == "s" and v else v
                    values += [v.strip()] if v is not None else []
                rows += ["\t".join(values)] if values else []
            out += [f"[Sheet: {name}]", *rows] if rows else []
    return "\n".join(out)


def hwp_paragraphs(section: bytes, compressed: bool = True, controls: dict[int, int] = rules.PARAGRAPH_CONTROLS) -> str:
    """Text of one body section's records: of each paragraph-text record (tag 67) the UTF-16 units up to 0, control
    units (below 32) skipped with the bytes that follow them."""
    data = zlib.decompress(section, -15) if compressed else section
    out, at = [], 0
    while at + 4 <= len(data):
        (head,) = struct.unpack_from("<I", data, at)
        at, size = at + 4, head >> 20
        if size == 0xFFF and at + 4 <= len(data):
            (size,) = struct.unpack_from("<I", data, at)
            at += 4
        if at + size > len(data):
            break
        if head & 0x3FF == 67:
            chars, i = [], at
            while i + 2 <= at + size:
                (unit,) = struct.unpack_from("<H", data, i)
                i += 2
                if not unit:
                    break
                if unit >= 32:
                    chars.append(unit)
                    continue
                chars += [10] if unit == 13 else [9] if unit == 9 else []
                i += controls.get(unit, 0)
            line = struct.pack(f"<{len(chars)}H", *chars).decode("utf-16-le", "replace")
            out += [line] if line.strip() else []
        at += size
    return "\n".join(out)


def salvaged(data: bytes) -> str:
    """Runs of five or more readable characters in a binary file, as UTF-16 or else as code page 949; lines once."""
    for code in ("utf-16-le", "cp949"):
        clean = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", data.decode(code, "ignore"))
        if runs := re.findall(rules.READABLE, clean):
            return "\n".join(s for s in (line.strip() for line in dict.fromkeys("\n".join(runs).split("\n"))) if s)
    return ""


def hwp(data: bytes) -> str:
    """The body sections of a word-processor file in their order; one that cannot be unpacked is left out."""
    held, out, n = Compound(data), [], 0
    compressed = bool(held.stream("FileHeader")[36] & 1)
    while (name := f"BodyText/Section{n}") in held:
        n += 1
        try:
            out.append(hwp_paragraphs(held.stream(name), compressed))
        except zlib.error:
            continue
    return "\n".join(x for x in out if x)


def doc(data: bytes) -> str:
    """What can be read of the main stream, else of the table stream."""
    held = Compound(data)
    if "WordDocument" not in held:
        return ""
    return salvaged(held.stream("WordDocument")) or (salvaged(held.stream("1Table")) if "1Table" in held else "")


def all_streams(data: bytes, least: int) -> str:
    """What can be read of each stream, if it is more than `least` characters; damaged streams are left out."""
    held, out = Compound(data), []
    for name in held.names():
        try:
            out.append(salvaged(held.stream(name)))
        except Damaged:
            continue
    return "\n".join(x for x in out if len(x.strip()) > least)


#: By extension. PDF needs a library that is added by the caller.
CONVERTERS: dict[str, Converter] = {**{e: plain_text for e in rules.TEXT_EXTENSIONS}, ".docx": docx, ".pptx": pptx, ".xlsx": xlsx, ".hwp": hwp, ".doc": doc, ".ppt": partial(all_streams, least=20), ".xls": partial(all_streams, least=10)}


def converted(files: DataFrame, converters: dict[str, Converter] | None = None) -> DataFrame:
    """Adds text and error to `files` (ext, content, others), without content. A file that cannot be converted
    has a null text and the cause as error; one without a converter the error `unsupported`."""
    converters = CONVERTERS if converters is None else converters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ext, data in zip(batch["ext"], batch.pop("content"), strict=True):
                try:
                    rows.append((converters[ext](data), None) if ext in converters else (None, "unsupported"))
                except Exception as e:  # a damaged file must not end the job; its cause is kept
                    rows.append((None, f"conversion: {type(e).__name__}: {e}"))
            yield batch.assign(text=[x for x, _ in rows], error=[x for _, x in rows])
        give_back()

    small_batches(files.sparkSession)
    files = files.drop("text", "error")
    return files.mapInPandas(run, files.drop("content").withColumns({"text": F.lit(None).cast("string"), "error": F.lit(None).cast("string")}).schema)
