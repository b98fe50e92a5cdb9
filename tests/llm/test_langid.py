from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from corpusmill.llm import langid


def brute_grams(text):
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(s.split()) + " "
    grams = Counter(c for c in s if c != " ")
    grams.update(s[i : i + 2] for i in range(len(s) - 1) if s.strip())
    grams.update(s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")
    return {sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g)): n for g, n in grams.items()}


def test_grams(monkeypatch):
    texts = ["Hello, wörld! x", "", None, "123", "a", "  a  b ", "ÀÉ日本", "the the the cat's"]
    for piece in (1 << 19, 3):
        monkeypatch.setattr(langid, "_PIECE", piece)
        for t in texts:
            grams, counts = langid.gram_counts(t)
            assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == brute_grams(t), (t, piece)


def test_ranks_and_distance():
    assert langid.most_frequent(np.array([1, 5, 9]), np.array([2, 7, 2]), 2).tolist() == [5, 1]
    model = langid.Profiles(["aa", "bb"], *_profile(), 10)
    text = "ab"
    own = [g for g, _ in sorted(brute_grams(text).items(), key=lambda x: (-x[1], x[0]))]
    away = {}
    for i, lang in enumerate(model.languages):
        ranks = {g: r for g, r in zip(model.grams.tolist(), model.ranks[i].tolist(), strict=True) if r < 10}
        away[lang] = sum(abs(ranks[g] - k) if g in ranks else 10 for k, g in enumerate(own))
    best = min(away, key=lambda x: (away[x], x))
    assert langid.closest(text, model) == (best, 1 - away[best] / (len(own) * 10))


def _profile():
    grams = np.sort(np.array([ord("a"), ord("b"), ord("a") << 21 | ord("b")]))
    return grams, np.array([[0, 1, 2], [2, 10, 0]], np.int32)


def test_held_out_accuracy(documents):
    docs = documents.withColumn("held_out", langid.held_out())
    model = langid.learn(docs.where("not held_out"))
    rows = langid.predict(docs.withColumn("score", F.lit("clash")), model).where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_edges(make, documents):
    model = langid.learn(documents)
    docs = make([None, "", "12 34 !!", "the and of", "the and of", "w " * 100_000])
    rows = langid.predict(docs.union(docs.where("doc_id = 3")), model).collect()
    assert [r.lang_pred for r in sorted(rows, key=lambda r: r.doc_id)[:3]] == ["und"] * 3 and len(rows) == 7
    assert langid.predict(docs.limit(0), model).count() == 0
    nothing = langid.learn(make([], lang=None))
    assert nothing.languages == [] and langid.closest("the", nothing) == ("und", 0.0)
    assert langid.learn(make(["a b", None], lang=None)).languages == []
    assert langid.learn(make(["ab ba"])).languages == ["en"]
