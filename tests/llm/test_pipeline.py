import corpus_pipeline
from corpusmill.llm.common import dropped, written

from .conftest import prose
from .test_minhash import brute as brute_components
from .test_suffixes import brute as brute_repeats


def test_stages_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], sf_dir)))
        if len(seen) < 6:
            assert seen[-1].columns == columns
    language, near, cut, mixed, packed = (s.collect() for s in seen[1:])
    assert {r.doc_id for r in language} == ids
    order = sorted(language, key=lambda r: r.doc_id)
    parts = brute_components([r.text for r in order], percent=80)
    assert {r.doc_id for r in near} == {order[c].doc_id for _, c in parts}
    order = sorted(near, key=lambda r: r.doc_id)
    kept = {r.doc_id: k.decode("utf-8", "ignore") for r, (k, _, _) in zip(order, brute_repeats([r.text for r in order], 200, "first"), strict=True)}
    assert {r.doc_id: r.text for r in cut} == {k: t for k, t in kept.items() if t.strip()}
    words = {r.doc_id: len(r.text.split()) for r in cut}
    total = sum(words.values())
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * total) < 0.05 * total
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}


def test_language_stage_keeps_what_is_clean(spark, make, documents):
    docs = documents.limit(150).union(make([None, "", "1 2 3 !!!", "日本語日本語"], first=10**6))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r.doc_id for r in documents.limit(150).collect()}


def test_copies_and_passages(spark, make):
    text, passage = prose(1, 200, 10_000), prose(2, 60, 10_000)
    docs = make([text, text, f"{prose(3, 50, 10_000)} {passage}", f"{passage} {prose(4, 50, 10_000)}"])
    near = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in near.collect()) == [0, 2, 3]
    cut = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, near, "").collect()}
    assert passage in cut[2] and passage not in cut[3] and cut[3].endswith(prose(4, 50, 10_000)) and cut[0] == text


def test_repeated_rows_go(spark, make):
    docs = make([prose(k, 50, 10_000) for k in range(4)] + ["a b", None, ""])
    nulls = make([prose(0, 50, 10_000), prose(9, 50, 10_000), prose(9, 50, 10_000)]).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    near = corpus_pipeline.near_duplicates(spark, docs.union(docs.where("doc_id < 3")).union(nulls), "")
    rows = [(r.doc_id, r.text) for r in near.collect()]
    want = [(None, prose(0, 50, 10_000)), (None, prose(9, 50, 10_000)), *[(k, prose(k, 50, 10_000)) for k in (1, 2, 3)], (4, "a b"), (5, None), (6, "")]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_replacement_characters_of_texts_stay(spark, make):
    passage = prose(2, 60, 10_000)
    docs = make([f"é{passage} one", f"good\ufffdtext ĩ{passage} end\ufffd"])
    cut = {r.doc_id: r for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    assert cut[1].text == "good\ufffdtext end\ufffd" and cut[1].n_chars == len(cut[1].text) and cut[0].text == f"é{passage} one"


def test_stage_tables_are_deleted(spark, sf_dir, monkeypatch):
    from pathlib import Path

    made = []
    monkeypatch.setattr(corpus_pipeline, "written", lambda df: made.append(written(df)) or made[-1])
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(k), lambda spark, docs, sf_dir: docs.where("doc_id > 5")) for k in range(3)] + [("last", lambda spark, docs, sf_dir: written(docs))])
    files = []
    monkeypatch.setattr(corpus_pipeline, "dropped", lambda df: (files.extend(df.inputFiles()), dropped(df)))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert len(made) == 3 and files and not any(Path(f.removeprefix("file://")).exists() for f in files)


def test_empty(spark, make):
    docs = make([])
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""))
        assert docs.count() == 0


def test_extra_columns_stay(spark, make):
    from pyspark.sql import functions as F

    docs = make([prose(k, 80, 10_000) for k in range(6)] + [prose(1, 80, 10_000), None])
    names = ["uid", "score", "size", "kept", "taken", "spans", "_uid", "_h", "bucket", "source_no", "lang_pred", "component_id", "a b"]
    docs = docs.select(*[F.lit(f"own {c}").alias(c) for c in names], *docs.columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = written(stage(spark, docs, ""))
        assert docs.columns == columns
        assert {tuple(r) for r in docs.select(*[f"`{c}`" for c in names]).collect()} == {tuple(f"own {c}" for c in names)}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_near_copies_from_80_percent(spark, make):
    """Pairs of 100 shingles each that differ in k at the end: likeness 0.85 at k = 8 to 0.74 at 15."""
    texts = []
    for k in range(8, 16):
        words = [f"t{k}w{i}" for i in range(104)]
        texts += [" ".join(words), " ".join(words[:-k] + [f"t{k}v{i}" for i in range(k)])]
    parts = brute_components(texts, percent=80)
    assert parts != brute_components(texts, percent=85) and len({c for _, c in parts}) > len(texts) // 2
    near = corpus_pipeline.near_duplicates(spark, make(texts), "").collect()
    assert {r.doc_id for r in near} == {c for _, c in parts}
