"""Text files that no task holds: their characters, their chunks, and the stream that takes them in."""

import io
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.functions.text import SPACES
from corpusmill.operators import chunking
from corpusmill.sources.characters import Characters
from corpusmill.sources.files import plain_text
from corpusmill.streaming import ingest as streaming

TEXTS = st.text(alphabet="ab. \n\ré가😀　", max_size=200)
DATA = st.one_of(st.binary(max_size=40), st.tuples(TEXTS, st.sampled_from(["utf-8", "cp949", "utf-16", "utf-16-le", "utf-16-be"])).map(lambda x: x[0].encode(x[1], "ignore")))


@settings(max_examples=100, deadline=None)
@given(DATA, st.integers(1, 9), st.integers(0, 200), st.integers(0, 200))
def test_characters_are_those_of_the_whole_text(data, block, start, more):
    got, want = Characters(lambda: io.BytesIO(data), block), plain_text(data)
    assert (got.length, got.stripped_length) == (len(want), len(want.strip(SPACES)))
    assert "".join(got.blocks(start, min(start + more, got.length))) == want[start : start + more]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab. \n", min_size=1, max_size=400), st.integers(1, 64), st.integers(0, 60), st.integers(8, 40), st.integers(0, 7), st.sampled_from([chunking.SEPARATORS, ("aba", "ab", "")]))
def test_chunks_are_those_of_the_whole_text(s, block, held, size, overlap, separators):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(chunking, "_HELD", held)
        long = Characters(lambda: io.BytesIO(s.encode()), block)
        total, chunks = chunking.counted(lambda: chunking.split_characters(long, size, overlap, separators), 3)
        want = chunking.split_text(s, size, overlap, separators)
        assert (total, list(chunks)) == (len(want), want)


@pytest.mark.parametrize("line", [b"some words of text. ", b"some words\n", b"\n\nsome words\n", b"x"])
def test_memory_does_not_grow_with_a_file(tmp_path, monkeypatch, line):
    monkeypatch.setattr(chunking, "_HELD", 1 << 13)
    peaks = []
    for times in (1, 8):
        (tmp_path / "a.txt").write_bytes(line * (times * (1 << 16) // len(line)))
        tracemalloc.start()
        long = Characters(lambda: (tmp_path / "a.txt").open("rb"), 1 << 13)
        total, chunks = chunking.counted(lambda: chunking.split_characters(long), 8)  # noqa: B023
        assert sum(1 for _ in chunks) == total > times * 50
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0]


@pytest.fixture
def small_rows(spark):
    """No file may be read whole in a row, unless it is small."""
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    yield spark
    spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def taken(spark, root, out, **more):
    streaming.ingest(streaming.file_stream(spark, str(root), **more), f"{out}/chunks", f"{out}/status", f"{out}/ck").awaitTermination()
    read = lambda name: sorted(map(tuple, spark.read.option("recursiveFileLookup", True).parquet(f"{out}/{name}").collect()), key=repr)
    return read("chunks"), read("status")


def test_a_stream_takes_in_files_of_any_length(small_rows, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "long one.txt").write_text("some text\n" * 3000)
    chunks, status = taken(small_rows, root, tmp_path)
    assert [(c[1], c[2], c[3]) for c in sorted(chunks, key=lambda c: c[2])] == [(x, k, len(chunks)) for k, x in enumerate(chunking.split_text("some text\n" * 3000))]
    assert status == [(f"file:{root}/long one.txt", "success", None)]


def test_opened_and_given_content_have_the_same_outcomes(spark, tmp_path, monkeypatch):
    root = tmp_path / "in"
    root.mkdir()
    for name, data in (("a.TXT", "가나다 라마\r\n".encode("cp949") * 900), ("b.sql", b" \n" * 900 + b"nine char"), ("c.docx", b"zz"), ("d.pdf", b"%PDF"), ("e.jpg", b"no"), ("f.txt", b" " * 900 + b"ten  chars")):
        (root / name).write_bytes(data)
    chunks, status = taken(spark, root, tmp_path / "one")
    assert (chunks, status) == taken(spark, root, tmp_path / "two", content=True)
    ends = {path.rsplit("/", 1)[1]: (end, reason) for path, end, reason in status}
    short = ("failed", "empty or too short")
    assert ends == {"a.TXT": ("success", None), "b.sql": short, "c.docx": ("failed", "conversion: BadZipFile: File is not a zip file"), "d.pdf": ("skipped", "unsupported"), "f.txt": ("success", None)}
    assert len({c[4] for c in chunks}) == 2
