import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import suffixes

from .conftest import prose


def brute(texts, length, keep):
    """(kept, removed, spans) for each text, from all windows."""
    at = {}
    for k, t in enumerate(texts):
        data = (t or "").encode()
        for i in range(len(data) - length + 1):
            at.setdefault(data[i : i + length], []).append((k, i))
    gone = [np.zeros(len((t or "").encode()) + 1, bool) for t in texts]
    for places in at.values():
        if len(places) > 1:
            for k, i in places[1:] if keep == "first" else places:
                gone[k][i : i + length] = True
    out = []
    for t, g in zip(texts, gone, strict=True):
        data = np.frombuffer((t or "").encode(), np.uint8)
        out.append((data[~g[:-1]].tobytes(), int(g.sum()), int((g[:-1] & ~np.r_[False, g[:-1][:-1]][: len(data)]).sum()) if len(data) else 0))
    return out


def passages():
    rng = random.Random(1)
    p = [prose(900 + k, 60, 10_000) for k in range(6)]
    texts = [prose(k, 80, 10_000) for k in range(12)]
    for k in range(40):
        cut = rng.randrange(0, 150)
        texts.append(prose(100 + k, 15, 10_000) + " " + p[k % 6][cut : cut + rng.randrange(150, 420)] + " " + prose(200 + k, 12, 10_000))
    texts += [texts[3], texts[3], None, "", "short", "ab" * 400, "é" * 300, texts[5] + texts[5], "x" * 199, "y" * 200, "y" * 200]
    return texts


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [4096, 3])
def test_repeats(make, keep, hot, monkeypatch):
    texts = passages()
    original = suffixes.repeats
    monkeypatch.setattr(suffixes, "repeats", lambda *a: original(*a, hot=hot))
    rows = suffixes.without_repeats(make(texts).withColumn("kept", F.lit("clash")), keep=keep).collect()
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in rows}
    want = brute(texts, 200, keep)
    assert len(rows) == len(texts)
    for k, w in enumerate(want):
        assert got[k] == w, (k, texts[k])


def test_both_modes_rest_on_longest_previous_factors(monkeypatch):
    import pandas as pd

    calls, original = [], suffixes.longest_previous
    monkeypatch.setattr(suffixes, "longest_previous", lambda *a: calls.append(a) or original(*a))
    datas = [b"0123456789abcdefghij", b"xx456789abcdyy", b"456789abzz"]
    segments = pd.DataFrame({"h": 1, "s1": range(3), "s2": 0, "doc_id": [5, 6, 7], "uid": 0, "first": 0, "m": [len(d) - 7 for d in datas], "times": 1, "data": datas})
    for earlier, want, n in ((False, {(0, 4, 7), (1, 2, 5), (2, 0, 1)}, 2), (True, {(1, 2, 5), (2, 0, 1)}, 1)):
        calls.clear()
        got = suffixes.matched_windows(segments, 8, earlier)
        assert {(r.s1, r.lo, r.hi) for r in got.itertuples()} == want and len(calls) == n


def test_whole_characters(make):
    assert suffixes.whole_characters("aébé".encode(), [(2, 3), (4, 5)]) == [(1, 3), (4, 6)]
    p = prose(8, 60, 10_000)
    rows = suffixes.without_repeats(make([f"é{p} one", f"ĩ{p} two"]), keep="first", whole=True).collect()
    assert {bytes(r.kept).decode() for r in rows} == {f"é{p} one", "two"}


def test_repeated_rows_and_empty_tables(make):
    one = make([prose(1, 100), prose(2, 100)])
    twice = one.union(one)
    assert {r.n_removed == r.n_bytes for r in suffixes.without_repeats(twice).collect()} == {True}
    assert {r.n_removed for r in suffixes.without_repeats(twice, keep="first").collect()} == {0}
    assert suffixes.without_repeats(one.limit(0)).count() == 0
    nulls = make([prose(1, 100)] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    assert suffixes.without_repeats(nulls).where("n_removed = n_bytes").count() == 2


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 4))
def test_longest_previous(data, least):
    order = sorted(range(len(data)), key=lambda i: data[i:])
    same = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    common = np.array([0] + [same(data[a:], data[b:]) for a, b in zip(order[:-1], order[1:], strict=True)])
    got = suffixes.longest_previous(np.array(order), common, least)
    for i, n in zip(order, got, strict=True):
        want = max((same(data[i:], data[j:]) for j in range(i)), default=0)
        assert n == (want if want >= least else 0)


def test_anchors_hang_on_the_window_alone():
    inner = prose(5, 90, 10_000).encode()
    places = []
    for around in (b"", b"zz" * 77):
        for key, first, m, place in suffixes.anchors(around + inner):
            places.append({(int(k), int(p) - len(around)) for k, f, n, p in zip(key, first, m, place, strict=True) if f >= len(around)})
            assert (first[1:] == first[:-1] + m[:-1]).all() and ((place >= first + m - 1) & (place < first + 153)).all()
    assert places[1] >= places[0] - {min(places[0], key=lambda x: x[1])}
