"""Files as texts: a data source that plans its partitions by bytes, opens only the files that its filters leave, and converts
them where they are read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith

from ..operators.tables import dropped, new_folder, placed
from .files import CONVERTERS, Converter
from .place import opened_for

#: Bytes of files that a task reads, about, and bytes of texts in a batch that it hands on.
PART_BYTES, BATCH_BYTES = 256 << 20, 16 << 20
NAME = "converted_files"
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _condition(f: Filter) -> pc.Expression | None:
    """A filter over the list's columns; None if it is of another kind."""
    if len(f.attribute) != 1:
        return None
    x = pc.field(f.attribute[0])
    match f:
        case EqualTo():
            return x == f.value
        case GreaterThan():
            return x > f.value
        case GreaterThanOrEqual():
            return x >= f.value
        case LessThan():
            return x < f.value
        case LessThanOrEqual():
            return x <= f.value
        case In():
            return x.isin(list(f.value))
        case IsNotNull():
            return x.is_valid()
        case StringStartsWith():
            return pc.starts_with(x, f.value)
        case StringEndsWith():
            return pc.ends_with(x, f.value)
    return None


@dataclass
class _Part(InputPartition):
    number: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], converters: dict[str, Converter]):
        self.folder, self.first, self.end = options["list"], int(options["first"]), int(options["end"])
        self.converters, self.names, self.filters = converters, options["names"].split(","), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if hasattr(f, "attribute") and f.attribute[0] in self.names and _condition(f) is not None:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Part(k) for k in range(self.first, self.end)]

    def _text(self, path: str, ext: str) -> tuple[str | None, str | None]:
        if ext not in self.converters:
            return None, "unsupported"
        fs, place = opened_for(path)
        with fs.open_input_stream(place) as f:
            data = f.read()
        try:
            return self.converters[ext](data), None
        except Exception as e:  # a damaged file must not end the job; its cause is kept
            return None, f"conversion: {type(e).__name__}: {e}"

    def read(self, partition: _Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # so Spark asks where there are none
            return
        fs, folder = opened_for(f"{self.folder}/part={partition.number}")
        wanted = None
        for f in self.filters:
            wanted = _condition(f) if wanted is None else wanted & _condition(f)
        rows = dataset.dataset(folder, filesystem=fs, format="parquet").to_table(columns=self.names, filter=wanted)
        found, at, size = [], 0, 0
        for k, (path, ext) in enumerate(zip(rows["path"].to_pylist(), rows["ext"].to_pylist(), strict=True)):
            found.append(self._text(path, ext))
            size += len(found[-1][0] or "")
            if size >= BATCH_BYTES or k == rows.num_rows - 1:
                part = rows.slice(at, k + 1 - at).combine_chunks()
                arrays = [*(part[c].combine_chunks() for c in self.names), *(pa.array([x[i] for x in found], pa.string()) for i in (0, 1))]
                yield pa.RecordBatch.from_arrays([a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays], [*self.names, "text", "error"])
                found, at, size = [], k + 1, 0


def source(converters: dict[str, Converter]) -> type[DataSource]:
    class ConvertedFiles(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def schema(self) -> str:
            return f"{self.options['columns']}, text string, error string"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(self.options, converters)

    return ConvertedFiles


@dataclass(frozen=True)
class FileList:
    """Files to read, written in parts of about equal bytes: where, how many parts, and the columns."""

    folder: str
    parts: int
    columns: str
    names: tuple[str, ...]


def listed(files: DataFrame, part_bytes: int = PART_BYTES) -> FileList:
    """Writes `files` (path, ext, length, others) in parts that begin where the bytes before them, in the order of path, reach
    the next multiple of `part_bytes`: a part is at most that and one file. The driver sees the number of parts only."""
    spark, names = files.sparkSession, files.columns
    laid = placed(files, [], ["path"], F.col("length"))
    rows = laid.select(*names, F.floor(F.col("_before") / part_bytes).alias("part"))
    # A file that is larger than a part leaves numbers out, which must not be read.
    numbers = rows.select("part").distinct()
    numbers = placed(numbers, [], ["part"]).select("part", F.col("_i").alias("number"))
    folder = new_folder(spark, "list")
    rows.join(numbers, "part").select(*names, F.col("number").alias("part")).write.partitionBy("part").parquet(folder)
    parts = numbers.count()
    dropped(laid, numbers)
    return FileList(folder, parts, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema), tuple(names))


def read(spark: SparkSession, files: FileList, converters: dict[str, Converter] | None = None, first: int = 0, end: int | None = None) -> DataFrame:
    """The columns of the list with text and error, of its parts from `first` to before `end`: a task for each. A filter on the list's
    columns is applied before a file is opened. A file that cannot be converted has a null text and the cause as error; one
    without a converter the error `unsupported`, unopened; one that is gone ends the job. Paths are local ones or of a store that
    Arrow can open."""
    spark.dataSource.register(source(CONVERTERS if converters is None else converters))
    spark.conf.set(_PUSHDOWN, "true")  # only lets such sources take filters
    options = {"list": files.folder, "columns": files.columns, "names": ",".join(files.names), "first": first, "end": files.parts if end is None else end}
    # A plan that pushes no filter would get those of the last one over the same source, so there is always one.
    return spark.read.format(NAME).options(**options).load().where(F.col("path").isNotNull())
