"""The data source of converted files, and runs that read only what they must and resume."""

import os

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import runs, state
from corpusmill.sources import files, reader


def written_files(root, sizes):
    root.mkdir(parents=True, exist_ok=True)
    for k, size in enumerate(sizes):
        (root / f"f{k:03d}.txt").write_text("x" * size)
    return root


def listed(spark, root, part_bytes):
    return reader.listed(files.scan(spark, str(root)).select("path", "ext", "length"), part_bytes)


def test_parts_hold_about_equal_bytes(spark, tmp_path):
    found = listed(spark, written_files(tmp_path / "in", [300, 10, 10, 5000, 1, 90, 90, 90, 90, 200]), 250)
    rows = reader.read(spark, found).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 10 and all(len(r.text) == r.length for r in rows)
    by: dict = {}
    for r in sorted(rows, key=lambda r: r.path):
        by.setdefault(r.task, []).append(r.length)
    assert len(by) == found.parts == max(by) + 1
    assert all(sum(v[:-1]) <= 250 for v in by.values())
    part = reader.read(spark, found, first=1, end=2).collect()
    assert [r.length for r in sorted(part, key=lambda r: r.path)] == by[1]


def test_only_what_the_filters_leave_is_opened(spark, tmp_path):
    root = written_files(tmp_path / "in", [10, 600, 700, 20])
    found = listed(spark, root, 1 << 20)
    for name in ("f000.txt", "f003.txt"):
        os.remove(root / name)  # whoever opens them fails
    rows = reader.read(spark, found)
    assert sorted(r.length for r in rows.where("length > 500").collect()) == [600, 700]
    assert [r.length for r in rows.where(F.col("path").endswith("f001.txt")).collect()] == [600]
    assert [r.length for r in rows.where(F.col("length").isin(700, 800)).select("length", "text").collect()] == [700]
    with pytest.raises(Exception, match="f00[03].txt"):
        rows.collect()


def test_texts_errors_and_other_columns(spark, tmp_path):
    root = written_files(tmp_path / "in", [])
    (root / "a b é.txt").write_bytes("한글\r\nx".encode("cp949"))
    (root / "bad.docx").write_bytes(b"no zip")
    (root / "scan.pdf").write_bytes(b"%PDF")
    found = files.scan(spark, str(root)).select("path", "ext", "length", F.lit(7).alias("mine"))
    rows = {r.path.rsplit("/", 1)[1]: r for r in reader.read(spark, reader.listed(found, 1)).collect()}
    assert rows["a b é.txt"].text == "한글\nx" and rows["a b é.txt"].mine == 7
    assert rows["bad.docx"].error.startswith("conversion: BadZipFile") and rows["scan.pdf"].error == "unsupported"
    assert reader.read(spark, reader.listed(found.limit(0))).collect() == []
    own = reader.read(spark, reader.listed(found.where("ext = '.pdf'")), {".pdf": lambda data: data.decode()}).first()
    assert own.text == "%PDF"


def names(df):
    return sorted(r.file_path.rsplit("/", 1)[1] for r in df.collect())


def test_a_run_opens_only_what_is_to_be_done(spark, tmp_path):
    root = written_files(tmp_path / "in", [40, 50, 60])
    store = state.StateStore(spark, f"file://{tmp_path}/state")
    opened = tmp_path / "opened"

    def noting(data: bytes) -> str:
        with open(opened, "a") as f:
            f.write(f"{len(data)}\n")
        return data.decode()

    go = lambda: names(runs.run(spark, str(root), store, f"{tmp_path}/vectors", converters={".txt": noting}))
    assert go() == ["f000.txt", "f001.txt", "f002.txt"] and sorted(opened.read_text().split()) == ["40", "50", "60"]
    (root / "f001.txt").write_text("y" * 55)
    (root / "f009.txt").write_text("z" * 70)
    opened.unlink()
    assert go() == ["f001.txt", "f009.txt"] and sorted(opened.read_text().split()) == ["55", "70"]
    opened.unlink()
    assert go() == [] and not opened.exists()


def test_a_run_that_dies_is_resumed(spark, tmp_path):
    root = written_files(tmp_path / "in", [100] * 8)
    store = state.StateStore(spark, f"file://{tmp_path}/state")
    calls = []

    def embed(chunks):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return chunks

    def go(how):
        return runs.run(spark, str(root), store, f"{tmp_path}/vectors", how, part_bytes=200, commit_bytes=200)

    with pytest.raises(RuntimeError, match="lost"):
        go(embed)
    held = {r.file_path.rsplit("/", 1)[1]: r.status for r in state.processed_files(store.log()).collect()}
    assert held == {f"f00{k}.txt": "completed" if k < 4 else "processing" for k in range(6)}
    assert names(go(lambda c: c)) == ["f004.txt", "f005.txt", "f006.txt", "f007.txt"]
    assert state.stats(state.processed_files(store.log())).first().completed == 8
    assert runs.current(spark, f"{tmp_path}/vectors").count() == 8
    log = [r.event for r in store.log().where("file_path like '%f004.txt'").orderBy("seq").collect()]
    assert log == ["processing", "pending", "processing", "completed"]


def test_files_are_written_listed_and_deleted_by_tasks(spark, tmp_path):
    """Rows with one key, or none, are files of their own; folders hold a bounded number of files; what is found is what Spark's source finds."""
    rows = spark.createDataFrame([(k if k % 7 else None, None if k == 3 else f"é {k % 4}\n") for k in range(40)] * 2, "k long, t string").repartition(3)
    assert files.write_texts(rows, f"{tmp_path}/in", "k", "t", 10) == 80
    assert max(len(names) for _, _, names in os.walk(tmp_path / "in")) <= 10
    (tmp_path / "in" / "_hidden.txt").write_text("x")
    (tmp_path / "in" / "other.jpg").write_text("x")
    show = lambda df: sorted((r.path, r.length, r.ext, r.modificationTime) for r in df.collect())
    found = files.scan_by_tasks(spark, f"file://{tmp_path}/in")
    assert show(found.withColumn("modificationTime", F.date_trunc("second", "modificationTime"))) == show(files.scan(spark, f"{tmp_path}/in").withColumn("modificationTime", F.date_trunc("second", "modificationTime")))
    read = reader.read(spark, reader.listed(found.select("path", "ext", "length"), 64))
    assert sorted(r.text for r in read.collect()) == sorted((r.t or "") + "\n" for r in rows.collect())
    files.delete_folders(found.select(F.regexp_extract("path", "^(.*)/", 1).alias("path")).distinct())
    assert not [x for _, _, names in os.walk(tmp_path / "in") for x in names if "k=" in x]
    assert files.scan_by_tasks(spark, f"{tmp_path}/in/none").count() == 0


def test_conversion_takes_few_files_at_a_time(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    held = spark.range(3000).repartition(1).select("id", F.lit(".txt").alias("ext"), F.lit("some text").cast("binary").alias("content"))
    assert files.converted(held).where("text = 'some text'").count() == 3000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
