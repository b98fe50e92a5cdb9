import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle

from .conftest import DOCS

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    path = []
    for nodes in tree[:-1]:
        k = i - i % 3
        path.append((nodes[k:i], nodes[i + 1 : k + 3]))
        i //= 3
    return path


def brute(rows):
    """The contract, one row at a time."""
    leaf = lambda r, text: h(*[field(x) for x in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = levels([leaf(r, r["text"]) for r in by[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for i, r in enumerate(by[s]):
            path = siblings(trees[s], i) + siblings(top, n)
            broken = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            folded = leaf(r, r["text"].replace("\n", "") if broken else r["text"])
            for left, right in path:
                folded = h(*left, folded, *right)
            out.append((r["doc_id"], leaf(r, r["text"]), trees[s][-1][0], top[-1][0], h(*[x for a, b in path for x in a + b]), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def made(rows):
    broken = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return sorted(map(tuple, merkle.manifest(rows, tampered={"text": broken}).collect()), key=repr)


def docs_of(spark, sizes, nulls=()):
    rows, n = [], 0
    for s, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7919 % 10007, f"line {n}\nline {n % 3}\r\n" if n % 4 else None, "en" if n % 5 else None, s, n if n % 6 else None))
    return spark.createDataFrame([*rows, *nulls], DOCS)


def test_sizes_around_whole_levels(spark):
    docs = docs_of(spark, {None: 1, "": 2, "a": 3, "b": 4, "c": 9, "d": 10, "é": 27, "z": 30})
    assert made(docs) == brute([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("block", [3, 9])
def test_rounds_of_small_blocks(spark, monkeypatch, block):
    """With small blocks there are several rounds, of leaves and of sources."""
    monkeypatch.setattr(merkle, "LEVELS", {3: 1, 9: 2}[block])
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "_STEPS", merkle._STEPS[: merkle.LEVELS])
    docs = docs_of(spark, {f"s{k}": 1 + k % 4 for k in range(12)} | {"hot": 100})
    assert made(docs) == brute([r.asDict() for r in docs.collect()])


def test_more_than_a_block(spark):
    docs = docs_of(spark, {"hot": 800, "cold": 5})
    assert made(docs) == brute([r.asDict() for r in docs.collect()])


def test_nulls_repeats_and_names(spark):
    twice = (5, "same\ntext", "en", "a", 9)
    odd = [(None, None, None, None, None), (None, "x", None, "a", 1), (None, "x", None, "a", 1), twice, twice, (5, "other", "en", "a", 5), (6, "long " * 50_000, "en", None, 250_000)]
    docs = docs_of(spark, {"a": 4}, odd)
    want = brute([r.asDict() for r in docs.collect()])
    assert made(docs) == want
    assert made(docs.withColumns({"leaf": F.lit(1), "_i": F.lit(2), "key": F.lit(3), "root": F.lit(4)})) == want


def test_empty(spark):
    got = merkle.manifest(spark.createDataFrame([], DOCS))
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_tampering_shows(spark):
    docs = docs_of(spark, {"a": 20})
    rows = merkle.manifest(docs, tampered={"text": F.when(F.col("doc_id") == 7919, F.lit("other"))}).collect()
    assert [r.doc_id for r in rows if not r.verified] == [7919] and len({r.root for r in rows}) == 1
