import io
import re
import struct
import zipfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import resilience, text
from corpusmill.functions.vectors import cosine
from corpusmill.operators import chunking, embedding, ingest, reports, requirements, search, state
from corpusmill.sources import files


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(("path", "want"), [("a/b.TXT", ".txt"), ("a/.hidden", ""), ("a/x.", ""), ("a.b/c", ""), ("t.tar.gz", ".gz")])
def test_suffix(spark, path, want):
    assert one(spark, text.suffix(F.lit(path))) == want


@pytest.mark.parametrize(("name", "want"), [("  core  ", "core"), ("__x-", "x"), ("a \t b", "a b"), ("_ a", " a")])
def test_project_name(spark, name, want):
    assert one(spark, text.project_name(F.lit(name))) == want


@pytest.mark.parametrize(("parts", "want"), [(["2015_x", "a"], "2015"), (["p2023", "d"], "2023"), (["none"], "m"), (["1985 2001", "b 1999"], "1999")])
def test_year(spark, parts, want):
    assert one(spark, text.year_in(F.array(*map(F.lit, parts)), F.lit("m"))) == want


@pytest.mark.parametrize(("words", "want"), [("a/Proposal.doc", "제안서"), ("설계 v1", "설계서"), ("latest", "시험"), ("zzz", "기타")])
def test_category(spark, words, want):
    assert one(spark, text.classified(F.lit(words))) == want


def test_json_payload(spark):
    for raw in ('{"k": 3}', '```json\n{"k": 3}\n```', 'So: {"k": 3} indeed'):
        assert one(spark, text.json_payload(F.lit(raw), "k int")["k"]) == 3
    assert one(spark, text.json_payload(F.lit("nothing"), "k int")) is None


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=400), st.integers(8, 40), st.integers(0, 7))
def test_split_text(s, size, overlap):
    chunks = chunking.split_text(s, size, overlap) if s.strip() else []
    assert all(c and c == c.strip() and len(c) <= size for c in chunks)
    letters = [c for c in s if c in "ab"]
    assert not letters or chunks
    assert sum(c in "ab" for c in "".join(chunks)) >= len(letters)


def test_fixed_windows(spark):
    for n in (0, 1, 999, 1000, 1001, 1800, 1801, 5000):
        got = one(spark, chunking.fixed_windows(F.lit("x" * n)))
        assert len(got) == (0 if n == 0 else 1 if n <= 1000 else 1 + -(-(n - 1000) // 800)), n


def test_chunks_of_blank_and_null(spark):
    docs = spark.createDataFrame([("a", None), ("b", "  \n"), ("c", "word " * 500)], "source_path string, text string")
    rows = chunking.chunked(docs).collect()
    assert {r.source_path for r in rows} == {"c"} and [r.chunk_index for r in rows] == list(range(rows[0].total_chunks))


def test_token_batches(spark):
    items = spark.createDataFrame([("g", i, t) for i, t in enumerate([5, 5, 20, 1, 1, 1, 1])], "g string, i int, t long")
    rows = chunking.token_batches(items, ["g"], ["i"], "t", 10, 3).orderBy("i").collect()
    assert [r.batch for r in rows] == [0, 0, 1, 2, 2, 2, 3]


def test_outcomes(spark):
    docs = spark.createDataFrame([(None,), ("",), (" 　 short\n",), ("long enough text",)], "text string")
    assert [r.status for r in ingest.with_outcome(docs).collect()] == ["failed", "failed", "failed", "success"]
    empty = ingest.ingest_stats(ingest.with_outcome(docs.limit(0)).withColumn("chunks", F.lit(1))).first()
    assert (empty.total, empty.success_rate) == (0, "0.0%")


def test_state_store(spark, tmp_path):
    store = state.StateStore(spark, f"file://{tmp_path}/state")
    rows = spark.createDataFrame([("a.txt", "h1", 1), ("b.txt", "h2", 2), ("c.hwp", "h3", 3)], "path string, file_hash string, length long")
    assert store.add_to_index(rows.limit(2), 1.0) == 2
    assert store.add_to_index(rows, 2.0) == 1
    assert sorted(r.seq_id for r in store.index().collect()) == [1, 2, 3]
    run = store.start_run(3, 1.0)
    events = [(1, "a.txt", "h1", "processing", None, None), (2, "a.txt", "h1", "completed", 5, None), (3, "b.txt", "h2", "processing", None, None)]
    events += [(4 + 2 * k + j, "c.hwp", "h3", e, None, x) for k in range(3) for j, (e, x) in enumerate([("processing", None), ("failed", "bad")])]
    store.append("log", state.LOG, [(*e, run, float(e[0])) for e in events])
    now = state.processed_files(store.log())
    assert state.dead_letters(now).first().file_path == "c.hwp" and state.retryable(now).isEmpty()
    assert [r.file_path for r in state.unprocessed(store.index(), now, retries=3).collect()] == ["b.txt"]
    assert {r.file_path for r in state.unprocessed(store.index(), now).collect()} == {"b.txt", "c.hwp"}
    assert store.reset_stale(9.0) == 1 and store.reset_stale(9.0) == 0
    assert state.stats(state.processed_files(store.log())).first().asDict() == {"completed": 1, "failed": 1, "processing": 0, "pending": 1, "total_chunks": 5}
    store.finish_run(run, 7.0)
    assert (store.runs().first().started_at, store.runs().first().finished_at) == (1.0, 7.0)
    assert store.get("k") is None
    store.put("k", "1", 1.0)
    store.put("k", "2", 2.0)
    assert store.get("k") == "2"


def test_search(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)] + [(60, [0.0] * 8)]
    df = spark.createDataFrame(vectors, "chunk_id long, embedding array<float>")
    m = np.array([v for _, v in vectors], np.float32).astype(float)
    units = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    want = {q: sorted(range(61), key=lambda i: (-round(float(units[q] @ units[i]), 12), i))[:5] for q in (0, 7, 20)}
    assert [r.chunk_id for r in search.top_k(df, vectors[7][1], 5).collect()] == want[7]
    queries = df.where(F.col("chunk_id").isin(0, 7, 20)).withColumnRenamed("chunk_id", "query_id")
    rows = search.top_k_each(df, queries, 5, block=2, part_rows=7).collect()
    assert {q: [r.chunk_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] for q in want} == want
    assert search.top_k_each(df, queries.limit(0), 5).count() == 0
    zero = F.array(*[F.lit(0.0)] * 8)
    assert df.select(cosine(F.col("embedding"), zero).alias("c")).distinct().collect()[0].c == 0.0
    new = spark.createDataFrame([(7, [1.0] * 8), (99, [2.0] * 8)], "chunk_id long, embedding array<float>")
    once = search.upsert(df, new)
    assert once.count() == 62 and search.upsert(once, new).count() == 62


def test_answer(spark):
    found = spark.createDataFrame([("c1", "body", 0.9, "p", None)], "chunk_id string, text string, score double, project string, file_name string")
    reply, sources = search.answer(found, "why?", lambda p: p)
    assert "### [1] p / unknown\nbody" in reply and "why?" in reply and sources[0]["score"] == 0.9
    assert search.answer(found.limit(0), "why?", lambda p: p) == (search.NOTHING_FOUND, [])


def test_embedding(spark):
    rows = embedding.embedded(spark.createDataFrame([("one two",), (None,), ("three",)], "text string"), dimension=32).collect()
    norms = [np.linalg.norm(r.embedding) for r in rows]
    assert abs(norms[0] - 1) < 0.01 and norms[1] == 0 and rows[0].embedding != rows[2].embedding

    def failing():
        def model(texts):
            if len(texts) > 1 or texts == ["bad"]:
                raise ValueError("no")
            return np.ones((1, 4))

        return model

    got = embedding.embedded(spark.createDataFrame([("a",), ("bad",)], "text string").coalesce(1), failing, 4).collect()
    assert [sum(r.embedding) for r in got] == [4.0, 0.0]


def test_errors_and_retries():
    kinds = [(FileNotFoundError(), "permanent"), (ValueError(), "permanent"), (zlib.error("x"), "permanent"), (RuntimeError("decompression failed"), "permanent"), (TimeoutError(), "transient"), (ConnectionError(), "transient"), (RuntimeError("?"), "transient")]
    assert all(resilience.error_kind(e) == k for e, k in kinds)

    def calls(*outcomes):
        left, seen = list(outcomes), []

        def call():
            seen.append(1)
            if isinstance(x := left.pop(0), Exception):
                raise x
            return x

        try:
            resilience.with_retries(call, 2, sleep=lambda _: None)
        except Exception:
            pass
        return len(seen)

    assert calls(1) == 1 and calls(TimeoutError(), TimeoutError(), 1) == 3 and calls(ValueError(), 1) == 1 and calls(*[TimeoutError()] * 9) == 3


def test_limiter():
    now = [0.0]
    limiter = resilience.RateLimiter(60, 600, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    limiter.acquire(5)
    limiter.acquire(5)
    assert abs(now[0] - 1) < 1e-6
    with pytest.raises(ValueError):
        limiter.acquire(1000)


def _zip(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in parts.items():
            z.writestr(name.replace("__", "/") + ".xml", body)
    return out.getvalue()


def test_office():
    w = 'xmlns:w="w"'
    doc = f"<w:document {w}><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:t>a</w:t></w:p></w:tc><w:tc><w:p><w:t>b</w:t></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"
    assert files.docx(_zip(word__document=doc)) == "One\na\tb"
    slide = '<p:sld xmlns:p="p" xmlns:a="a"><a:p><a:r><a:t>Hi</a:t></a:r></a:p></p:sld>'
    assert files.pptx(_zip(ppt__slides__slide2=slide, ppt__slides__slide1='<p:sld xmlns:p="p"/>')) == "[Slide 2]\nHi"
    sheet = '<worksheet><sheetData><row><c t="s"><v>0</v></c><c><v>4</v></c></row></sheetData></worksheet>'
    book = '<workbook><sheets><sheet name="S"/></sheets></workbook>'
    assert files.xlsx(_zip(xl__workbook=book, xl__worksheets__sheet1=sheet, xl__sharedStrings="<sst><si><t>x</t></si></sst>")) == "[Sheet: S]\nx\t4"


def test_hwp_records():
    def record(tag, body):
        return struct.pack("<I", tag | len(body) << 20) + body

    line = "가나".encode("utf-16-le") + struct.pack("<H", 9) + b"\0" * 6 + "x".encode("utf-16-le") + struct.pack("<H", 13)
    raw = record(66, b"zz") + record(67, line) + record(67, "둘".encode("utf-16-le")) + struct.pack("<I", 67 | 500 << 20)
    packed = zlib.compressobj(wbits=-15)
    assert files.hwp_paragraphs(packed.compress(raw) + packed.flush()) == "가나\tx\n\n둘"


def test_converted(spark):
    rows = [(".txt", "héllo\r\nx".encode()), (".txt", "한글".encode("cp949")), (".docx", b"broken"), (".pdf", b"")]
    got = files.converted(spark.createDataFrame(rows, "ext string, content binary")).collect()
    assert [r.text for r in got] == ["héllo\nx", "한글", None, None]
    assert got[2].error.startswith("conversion: BadZipFile") and got[3].error == "unsupported"
    assert files.salvaged("읽을 수 있는 글".encode("utf-16-le")) == "읽을 수 있는 글"


def test_scan_and_stream(spark, tmp_path):
    from corpusmill.streaming.ingest import file_stream, ingest as run

    root = tmp_path / "in"
    (root / "2019 core").mkdir(parents=True)
    for name, body in (("a.TXT", "some text " * 300), ("b.txt", "x"), ("c.jpg", "no")):
        (root / "2019 core" / name).write_text(body)
    found = files.scan(spark, str(root))
    assert sorted(r.ext for r in found.collect()) == [".txt", ".txt"] and "content" not in found.columns
    meta = ingest.with_metadata(found, found.select("path").first().path.rsplit("/", 2)[0]).collect()
    assert {m.year for m in meta} == {"2019"} and {m.project for m in meta} == {"2019 core"}
    for _ in range(2):
        run(file_stream(spark, str(root)), f"{tmp_path}/chunks", f"{tmp_path}/status", f"{tmp_path}/ck").awaitTermination()
        status = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/status").collect()
        assert sorted((r.status, r.reason) for r in status) == [("failed", "empty or too short"), ("success", None)]
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/chunks").count() == 4


def test_front_matter_and_pages(spark, tmp_path):
    (tmp_path / "p.md").write_text("---\nid: a\n---\nbody --- text\n")
    (tmp_path / "q.md").write_text("no header")
    row = files.front_matters(spark, str(tmp_path)).first()
    assert (row.header, row.body) == ("id: a\n", "body --- text\n")
    old = spark.createDataFrame([("a", 1, "kept")], "id string, file_count int, client string")
    new = spark.createDataFrame([("a", 5, "x"), ("b", 2, "y")], "id string, file_count int, client string")
    got = {r.id: (r.file_count, r.client) for r in reports.page_fields(old, new, ["file_count"], ["client"]).collect()}
    assert got == {"a": (5, "kept"), "b": (2, "y")}
    lines = new.select(reports.front_matter(["id", "file_count"]).alias("x")).collect()
    assert lines[0].x == '---\nid: "a"\nfile_count: 5\n---\n'


def test_requirement_names(spark):
    rows = [("a/요구사항정의서 v1.doc", True), ("양식/요구사항정의서.doc", False), ("a/~$요구사항정의서.doc", False), ("a/요구사항정의서 양식.doc", False), ("a/요구사항.doc", False), ("요구사항 목록.xls", True)]
    got = spark.createDataFrame(rows, "path string, want boolean").withColumn("got", requirements.is_requirement_document(F.split("path", "/")))
    assert got.where("got <> want").isEmpty()
    assert one(spark, text.doc_key(F.lit("설계서_ver1.2b_20190412 (2)"))) == "설계서"
    assert one(spark, text.labels(F.lit("SSO 로그인 화면 API"))) == ["인증/로그인", "데이터연계/인터페이스"]


@pytest.mark.parametrize(("stem", "want"), [("plan ver20230101120000", [20230101120000]), ("x Ver\u00a0 3.07c", [3, 7, 3]), ("p\u3000ver.\u30002.1", [2, 1]), ("ver" + "9" * 60, [int("9" * 60)]), ("ver000.010", [0, 10]), ("none", [0]), ("ver \u0663.1", [3, 1])])
def test_versions_of_any_length(spark, stem, want):
    assert [int(x["number"]) for x in one(spark, text.version_numbers(F.lit(stem)))] == want


def test_versions_compare_as_numbers(spark):
    stems = ["a ver9", "a ver10", "a ver10a", "a ver10.0", "a ver10.1", "a ver099", "a ver100000000000000000000", "a ver100000000000000000001", "a"]
    rows = spark.createDataFrame([(s,) for s in stems], "s string").orderBy(text.version_numbers("s"))
    assert [r.s for r in rows.collect()] == sorted(stems, key=lambda s: ([int(x) for x in re.findall("[0-9]+", s)] + [1] * s.endswith("a") if "ver" in s else [0]))


def test_names_with_other_spaces(spark):
    assert one(spark, text.doc_key(F.lit("plan\u2003v12\u3000 final\u00a0"))) == "plan final"
    assert one(spark, text.doc_key(F.lit("plan\u3000ver\u30002.1"))) == "plan"
    f = one(spark, text.folder_fields(F.lit("(2015.3\u00a0- 2016.11)\u3000Core")))
    assert (f.period_start, f.period_end, f.title) == ("2015-03", "2016-11", "Core")
    assert one(spark, text.year_in(F.array(F.lit("p 20\u0662\u0660")), F.lit("m"))) == "2020"
    assert one(spark, text.classified(F.lit("New RFP")))  == "제안서"


def test_ingestion_run(spark, tmp_path):
    from corpusmill.config import Settings
    from corpusmill.operators import runs

    root = tmp_path / "in"
    (root / "Core 2012").mkdir(parents=True)
    for k in range(12):
        (root / "Core 2012" / f"report_{k:03d}.txt").write_text(f"sentence {k}. " * 150)
    (root / "tiny.txt").write_text("x")
    (root / "scan.pdf").write_bytes(b"%PDF")
    store = state.StateStore(spark, f"file://{tmp_path}/state")
    go = lambda **more: sorted((r.file_path.rsplit("/", 1)[1], r.status, r.reason) for r in runs.run(spark, str(root), store, f"{tmp_path}/vectors", lambda c: embedding.embedded(c, dimension=16), **more).collect())
    first = {*go(max_files=13), *go(max_files=2)}
    assert sorted(x for x in first if x[1] != "success") == [("scan.pdf", "skipped", "unsupported"), ("tiny.txt", "failed", "empty or too short")]
    assert [x[0] for x in go()] == ["scan.pdf", "tiny.txt"]  # only what failed
    (root / "Core 2012" / "report_003.txt").write_text("changed text that is short")
    assert "report_003.txt" in [x[0] for x in go()]
    rows = runs.current(spark, f"{tmp_path}/vectors")
    assert rows.where("source_path like '%report_003.txt'").count() == 1 and rows.select("project", "year", "category").distinct().collect()[0] == ("Core 2012", "2012", "보고서")
    assert state.dead_letters(state.processed_files(store.log())).count() == 2 and len(store.runs().collect()) == 4
    assert len(go(resume=False)) == 14
    assert Settings.from_env({"TOP_K": "3"}).top_k == 3
    assert [r.folder for r in files.top_folders(files.scan(spark, str(root)), f"file:{root}").collect()] == ["Core 2012"]


def test_extraction(spark):
    docs = spark.createDataFrame([("a", "a.doc", "long enough " * 5), ("b", "b.doc", "short"), ("c", "c.doc", "no json here, but a text"  * 3), ("d", "d.doc", "known " * 9)], "source_rel string, source_file string, text string")
    known = spark.createDataFrame([("d",)], "source_rel string")

    def extract(body, name):
        return "none" if name == "c.doc" else '```json\n{"requirements": [{"req_name": "n", "req_detail": "' + str(len(body)) + '"}]}\n```'

    got = {r.source_rel: r for r in requirements.extracted(docs, extract, known, most=40).collect()}
    assert set(got) == {"a", "b", "c"} and (got["b"].error, got["c"].error) == ("too short", "no JSON")
    assert got["a"].requirements[0].req_detail == "40" and got["a"].error is None


def test_strip_is_linear(spark):
    import time

    from corpusmill.functions import text

    rows = [("a" + " " * 1_000_000 + "b",), ("\u3000 x\x85\n",), (" ",), (None,), ("",)]
    df = spark.createDataFrame(rows, "t string").cache()
    df.count()
    began = time.perf_counter()
    got = [r[0] for r in df.select(text.strip("t")).collect()]
    assert time.perf_counter() - began < 5 and got == [t if t is None else t.strip() for (t,) in rows]


def test_upsert_keeps_the_last_write(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "chunk_id string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 9), ("b", 3), ("c", 4)], "chunk_id string, v int").coalesce(1)
    assert {tuple(r) for r in search.upsert(old, new).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert {tuple(r) for r in search.upsert(old, new, order="v").collect()} == {("a", 1), ("b", 3), ("c", 9)}
