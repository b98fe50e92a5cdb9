import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import tokencount

from .conftest import DOCS, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
HARD = ["it's we'LL ", "<|endoftext|>", "<|startoftext|", "''s", "12345", "日本語。", "ȩ́", "각", "각", "≠", "  \n", "ΣΑΣ ", "İ", "😀", "_x_", "!?'s", "x" * 40]


def count(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


def rows_of(texts):
    return [(i, t, "en", "s", None) for i, t in enumerate(texts)]


def held(spark, texts, **sizes):
    got = tokencount.token_counts(spark.createDataFrame(rows_of(texts), DOCS), PATH, **sizes).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [(i, len((t or "").encode()), count(t), count(t) > 2048) for i, t in enumerate(texts)]


def test_whole_texts(spark, documents):
    docs = documents.select("doc_id", "text").collect()
    got = {r.doc_id: r for r in tokencount.token_counts(documents, PATH).collect()}
    assert {d.doc_id: (len((d.text or "").encode()), count(d.text)) for d in docs} == {k: (r.n_bytes, r.n_tokens) for k, r in got.items()}


def test_chunks_of_many_kinds(spark):
    """Chunks far smaller than the texts, which hold whatever a chunk's end can cut in two."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(HARD) + rng.choice(["", "", " "]) for _ in range(rng.randrange(400))) for _ in range(30)]
    held(spark, [*texts, prose(3, 2500), None, "", " " * 500], chunk=60, overlap=20)


def test_widening(spark):
    """No word starts for longer than a chunk: only wider ones find a common place, or the text is one chunk."""
    texts = ["a" * 3000, "b " * 50 + "c" * 700 + " d" * 900, "日" * 900 + "。" + "本" * 900, "\n" * 5000, "<|endoftext|>" * 90, "́" * 400 + "x"]
    held(spark, texts, chunk=50, overlap=10)


def test_characters_that_become_two(spark):
    """Lower-casing or composing makes a letter and a mark of one character: a word begins within it."""
    held(spark, ["aİ" * 60, "İ " * 60, "क़" * 40 + "\u0958" * 40, "x İİİ y " * 20], chunk=11, overlap=5)


@pytest.mark.parametrize("end", range(2, 15))
def test_special_strings_that_a_chunk_cuts(end):
    """Before its end is seen a special string looks like words, whose places are none."""
    text = "1<|endoftext|> and more"
    _, left, _ = tokencount.boundaries(TOKENIZER, text[:end], False)
    assert not [p for p in left if 1 < p < 14]


def test_copies_and_nulls(spark):
    long = prose(9, 800)
    docs = spark.createDataFrame([(None, long, None, None, None), (7, long, None, None, None), (7, long, None, None, None), (None, None, None, None, None)], DOCS)
    got = tokencount.token_counts(docs.withColumns({"key": F.lit(1), "n_tokens": F.lit(2), "chunk": F.lit(3)}), PATH, limit=10, chunk=100, overlap=30).collect()
    n = count(long)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(None, len(long), n, True), (7, len(long), n, True), (7, len(long), n, True), (None, 0, 0, False)]))


def test_empty(spark):
    got = tokencount.token_counts(spark.createDataFrame([], DOCS), PATH)
    assert got.count() == 0 and got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_other_tokenizers_count_whole_texts(spark):
    other = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, text = Tokenizer.from_file(other), prose(1, 300)
    got = tokencount.token_counts(spark.createDataFrame(rows_of([text]), DOCS), other, chunk=50, overlap=10).first()
    assert got.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(HARD), st.text(max_size=6)), max_size=30), st.integers(0, 10**6))
def test_common_places_are_safe(pieces, seed):
    """Wherever a scan from the start and one from the middle share a place, the counts on both sides add up."""
    text = "".join(pieces).encode("utf-8", "ignore").decode()
    if len(text) < 4:
        return
    cut = seed % (len(text) - 2) + 1
    end = cut + seed % (len(text) - cut) + 1
    n_left, left, before = tokencount.boundaries(TOKENIZER, text[:end], end == len(text))
    n_right, right, after = tokencount.boundaries(TOKENIZER, text[cut:], True)
    shared = {cut + a: n for a, n in zip(right, after)}
    for a, n in zip(left, before):
        if a in shared:
            assert n + n_right - shared[a] == count(text)


@pytest.mark.parametrize("c, opens", [("a", True), ("日", True), ("́", False), ("ᅡ", False), ("ᆨ", False), ("゙", False), ("가", True), (" ", True), ("İ", False), ("\u0958", False)])
def test_openers(c, opens):
    assert tokencount._opens(c) == opens
