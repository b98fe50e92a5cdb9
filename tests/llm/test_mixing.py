from pyspark.sql import functions as F

from corpusmill.llm import mixing

from .conftest import prose


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > cap * sizes[s]]
        for s in above or open_.copy():
            out[s] = cap * sizes[s] if above else level * weight[s]
            left -= out[s]
            open_.discard(s)
    return out


def test_targets(spark):
    for sizes in ({"a": 100, "b": 1000, "Ä": 30, None: 400, "é": 0}, {"a": 5}, {"a": 0, "b": 0}, {f"s{i}": (i * 37) % 90 + 1 for i in range(40)}):
        rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes)
        assert all(abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) for r in rows) and len(rows) == len(sizes)


def test_every_run_of_slots_is_near_the_shares(spark):
    sources = spark.createDataFrame([(1, 5000.0), (2, 2000.0), (3, 1000.0), (4, 0.0)], "source_no int, target double")
    slots = sorted((r.slot, r.source_no, r.block) for r in mixing.schedule(sources, 2, 300).collect())
    assert [s for s, _, _ in slots] == list(range(4000))
    for source, share in ((1, 0.625), (2, 0.25), (3, 0.125)):
        mine = [i for i, s, _ in slots if s == source]
        assert [b for _, s, b in slots if s == source] == list(range(len(mine)))
        assert all(abs(k + 1 - share * (i + 1)) < 6 for k, i in enumerate(mine))


def test_small_sources_get_their_targets(make):
    sizes = {"large": 20_000} | {f"s{k:03d}": k for k in range(1, 101)}
    names = [n for n in sizes for _ in range(40 if n == "large" else 1)]
    docs = make([prose(i, sizes[n] // (40 if n == "large" else 1)) for i, n in enumerate(names)], source=names.__getitem__)
    rows, want, got = mixing.taken(mixing.mix(docs)).collect(), brute_targets(sizes), {}
    for r in rows:
        assert r.taken <= 2 * r.size
        got[r.source] = got.get(r.source, 0) + r.taken
    assert got == {n: round(t) for n, t in want.items()}


def test_golden_points_hit_each_place_once(spark):
    for n in (1, 2, 3, 7, 64, 1000, 2310):
        assert sorted(r[0] for r in spark.range(n).select(mixing.golden_points(F.col("id"), n)).collect()) == list(range(n))
    n = 3 * 10**12 + 7
    got = [r[0] for r in spark.range(n - 3, n).select(mixing.golden_points(F.col("id"), n)).collect()]
    assert sorted(got) == sorted(t * mixing.golden_step(n) % n for t in range(n - 3, n))


def test_taken(make, spark):
    texts = [prose(k, 20 + 7 * (k % 50)) for k in range(400)] + [None, "", " \n", "one", prose(1, 900), "　a b"]
    docs = make(texts, source=lambda i: None if i % 9 == 0 else "hot" if i % 3 else f"s{i % 4}").withColumn("size", F.lit("clash"))
    docs = docs.union(docs.where("doc_id = 7"))
    rows = mixing.taken(mixing.mix(docs, per_bucket=50)).collect()
    assert len(rows) == len(texts) + 1
    by = {}
    for r in rows:
        want = len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")])
        assert r.size == want and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert sum(r.size for r in rs) == rs[0].source_size
        assert sum(r.taken for r in rs) == round(rs[0].target)
    again = mixing.taken(mixing.mix(docs.repartition(7), per_bucket=50)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mixed_documents(make):
    docs = make([prose(k, 50) for k in range(40)] + ["", None])
    mixed = mixing.mix(docs, keep_text=True)
    rows = mixing.mixed_documents(mixed, docs.columns).collect()
    used = {r.doc_id: r.taken for r in mixing.taken(mixed).collect()}
    words = {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == {k: n for k, n in used.items() if n}


def test_empty(make):
    assert mixing.taken(mixing.mix(make([]))).count() == 0
    assert [r.taken for r in mixing.taken(mixing.mix(make([None, ""]))).collect()] == [0, 0]
