import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import ranked_search
from strata.llm.ranked_search import SharedQueries, search, terms


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(ranked_search.TERMS, lower)


def brute(docs, items, k=50):
    bags = [(i, Counter(split(t)), len(split(t))) for i, t in docs if split(t)]
    n, length = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = []
    for item, ts in asked.items():
        rows = []
        for i, c, m in bags:
            norm = 100 - 50 + (50 * m * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * norm))
                    for t in ts if t in c)
            if s > 0:
                rows.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(rows, key=lambda x: (x[0], x[1], 0 if x[2] is None else x[2]))[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(n, seed=1, length=40):
    r = random.Random(seed)
    word = lambda: r.choice(["Ñandú", "The", "the", "a1", "x-y", "don't"]) if r.random() < 0.2 else f"w{int(r.paretovariate(0.8)) % 300}"
    return [" ".join(word() for _ in range(r.randrange(length))) for _ in range(n)]


@pytest.mark.parametrize("k, block, room", [(50, 200_000, 4_000_000), (5, 60, 3000)])
def test_equals_brute_force(spark, docs, monkeypatch, k, block, room):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(ranked_search, "ACCUMULATORS", room)
    texts = made(300) + [None, "", "--- ..."]
    texts += texts[:40]                                 # copies: equal scores
    ids = [*range(len(texts) - 3), 4, 4, None]
    items = [(i, t) for i, t in enumerate(made(25, 2, 12))] + [(3, "more words w1 w2"), (90, None), (91, "!!"), (None, "w5 the")]
    want = brute(list(zip(ids, texts)), items, k)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(docs(texts, ids).repartition(7), asked, k)) == want


def test_other_types_and_columns(spark, docs):
    df = spark.createDataFrame([("b", "x y", 1), ("a", "x y", 2), (None, "x", 3)], "name string, body string, rank int")
    items = spark.createDataFrame([("q", "X", 0)], "q string, text string, score int")
    want = [(i, r, d, s) for i, r, d, s in brute([("b", "x y"), ("a", "x y"), (None, "x")], [("q", "X")])]
    assert got(search(df, items, 50, "name", "body", "q")) == want


def test_taken_names(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "y")], "score long, text string")
    items = spark.createDataFrame([(9, "x")], "score long, text string")
    got = search(df, items, 50, "score", "text", "score")
    assert got.columns == ["item_id", "rank", "document_id", "score"] and [(r.item_id, r.document_id) for r in got.collect()] == [(9, 1)]


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert search(docs([]), items).count() == 0 and search(docs(["", None]), items).count() == 0
    assert search(docs(["x"]), items.limit(0)).count() == 0


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(ranked_search, "CHUNK", 7)
    for t in made(200, 4):
        assert [x.decode() for part in terms(t.encode()) for x in part] == split(t)


def test_shared_sums():
    r = random.Random(2)
    for _ in range(40):
        n = r.randrange(1, 30)
        items = [sorted(r.sample(range(n), r.randrange(n + 1))) for _ in range(r.randrange(1, 20))]
        items += items[:3]
        dag = SharedQueries(items, n)
        impact = np.array([[r.randrange(100) for _ in range(5)] for _ in range(n)], np.int64).reshape(n, 5)
        assert (dag.scores(impact) == np.array([impact[i].sum(axis=0) for i in items])).all()
    shared = [list(range(20)) + [20 + i] for i in range(10)]
    assert sum(len(s[0]) for s in SharedQueries(shared, 30).steps) == 19 + 10     # the common set is added up once
