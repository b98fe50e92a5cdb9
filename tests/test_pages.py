"""Pages as files, and headers with fields that nothing here knows."""

import json

import pytest
import yaml
from pyspark.sql import functions as F

from corpusmill.operators import pages


def test_a_page_with_most_rows_is_whole(spark, tmp_path):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 > 0, "deep/hot.md").otherwise(F.concat(F.lit("p"), (F.col("id") % 70).cast("string"), F.lit(".md"))).alias("name"), F.lit(0).alias("section"), (5000 - F.col("id")).alias("place"), F.when(F.col("id") != 77, F.concat(F.lit("line é "), F.col("id").cast("string"))).alias("line"))
    for _ in range(2):  # a second time in place of the first
        got = {r.name: (r.lines, r.bytes) for r in pages.write_pages(rows, f"file://{tmp_path}/out").collect()}
    want: dict = {}
    for r in rows.orderBy("place").collect():
        want.setdefault(r.name, []).append(r.line or "")
    assert set(got) == set(want) and got["deep/hot.md"][0] == 4500
    for name, lines in want.items():
        data = (tmp_path / "out" / name).read_bytes()
        assert data.decode().split("\n") == [*lines, ""] and len(data) == got[name][1]
    assert sorted(p.name for p in (tmp_path / "out" / "deep").iterdir()) == ["hot.md"]


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "name string, section int, place long, line string")
    assert pages.write_pages(none, f"{tmp_path}/out").collect() == []


HEADERS = [
    (1, "title: old\nstatus: done\nnote: {deep: [1, 2.5, null, ja], when: 2020-01-02}\nfile_count: 3\n"),
    (2, ""),
    (3, None),
    (4, "[not, an, object]"),
    (5, "bad: [unclosed"),
    (7, "title: nobody asks for it"),
]


def test_fields_forced_defaulted_and_unknown(spark):
    old = pages.with_fields(spark.createDataFrame(HEADERS, "id int, header string"))
    assert {r.id: bool(r.header_error) for r in old.select("id", "header_error").collect()} == {1: False, 2: False, 3: False, 4: False, 5: True, 7: False}
    new = spark.createDataFrame([(k, k * 10, f"t{k}", None if k == 2 else "open") for k in (1, 2, 3, 4, 5, 6)], "id int, file_count int, title string, status string")
    merged = pages.merged_fields(old, new, ["file_count"], ["title", "status"])
    got = {r.id: json.loads(r.x) for r in merged.select("id", F.to_json("fields").alias("x")).collect()}
    assert got[1] == {"title": "old", "status": "done", "file_count": 10, "note": {"deep": [1, 2.5, None, "ja"], "when": "2020-01-02"}}
    assert got[2] == {"file_count": 20, "title": "t2"}
    assert got[6] == {"file_count": 60, "title": "t6", "status": "open"} and len(got) == 6
    texts = {r.id: r.x for r in merged.select("id", pages.header_text(F.col("fields"), ["title", "file_count"]).alias("x")).collect()}
    assert texts[1].split("\n")[:4] == ["---", 'title: "old"', "file_count: 10", 'note: {"deep":[1,2.5,null,"ja"],"when":"2020-01-02"}']
    assert {k: yaml.safe_load(x.split("---\n")[1]) for k, x in texts.items()} == got
    again = pages.merged_fields(merged, new.withColumn("file_count", F.lit(7)), ["file_count"], ["title", "status"])
    assert json.loads(again.where("id = 1").select(F.to_json("fields")).first()[0]) == got[1] | {"file_count": 7}


def test_pages_are_generated_and_kept(spark, tmp_path):
    registry = spark.createDataFrame([("core", "Core (2015)", "The core", "2015-03", "2016-11", False, None), ("y", "2004", None, None, None, True, "old"), ("gone", "No files", "x", None, None, False, None)], "slug string, raw_name string, title string, period_start string, period_end string, is_yearly boolean, domain string")
    counts = spark.createDataFrame([("Core (2015)", 7, {".pdf": 4, ".doc": 3}), ("2004", 1, {".txt": 1})], "raw_name string, file_count int, formats map<string, int>")
    old = spark.createDataFrame([("core/index.md", "title: Mine\nfile_count: 1\nclient: ACME\nid: wrong\n", "\nwritten by hand\n")], "name string, header string, body string")
    got = {r.name: r.lines for r in pages.write_pages(pages.generated(registry, counts, old), f"{tmp_path}/out").collect()}
    assert set(got) == {"core/index.md", "yearly/y.md"}
    core = (tmp_path / "out/core/index.md").read_text()
    head, body = core.split("---\n")[1:]
    assert body == "\nwritten by hand\n"
    assert yaml.safe_load(head) == {"id": "core", "title": "Mine", "period_start": "2015-03", "period_end": "2016-11", "domain": "etc", "status": "completed", "source_path": "Core (2015)", "file_count": 7, "formats": {".pdf": 4, ".doc": 3}, "client": "ACME"}
    assert (tmp_path / "out/yearly/y.md").read_text().split("---\n")[2] == "\n".join(pages.DEFAULT_BODY) + "\n"
    assert {r.name for r in pages.generated(registry, counts, old, "core").select("name").distinct().collect()} == {"core/index.md"}
    with pytest.raises(ValueError, match="no project 'nope'"):
        pages.generated(registry, counts, old, "nope")


def test_headers_are_read_by_the_fast_parser(monkeypatch):
    if not hasattr(yaml, "CSafeLoader"):
        return
    header = "file_count: -1\nnote: 'é: x'\nday: 2020-01-02\nmore:\n  depth: 4\n  list: [1, two, null]"
    want = yaml.safe_load(header)
    monkeypatch.setattr(yaml, "SafeLoader", None)
    monkeypatch.setattr(yaml, "safe_load", None)
    got = json.loads(pages._fields(header))
    assert got == {**want, "day": "2020-01-02"} and pages._fields(None) == pages._fields("- 1") == "{}"
