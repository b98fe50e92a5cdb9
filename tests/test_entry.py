import __spark_entry__ as entry


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "chunks"] and df.count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_imports_the_optional_part():
    from pathlib import Path

    root = Path(entry.__file__).parent / "corpusmill"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm." not in path.read_text() and "import llm" not in path.read_text(), path
