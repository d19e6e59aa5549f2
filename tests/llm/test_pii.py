"""Fixed patterns against regular expressions; message passing against sums over
all labellings; consistency of added spans."""
import hashlib
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import pii as P
from strata.llm.queries import op8
from tests.conftest import SF_SMALL

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((k, *m.span()))
    return out


def texts():
    r = random.Random(3)
    parts = ["a", "bob", "@", "@", ".", "com", "x.org", "-", "+", "1", "12", "255", "256", "0007", " ", " ", "(", ")", "4111111111111111",
             "4111-1111 1111 1111", "+1 (017) 555-7713", "\n", "é", "%", "_", "1.2.3.4", "#", "5500005555555559"]
    out = ["", "@", "a@b", "a@b.c", "a@@b.c", "x@y.z@w.v", "a@b.c.d..e", "1.2.3.4.5.6.7.8", "1.2.3.256", "+1", "+12345678(", "+" * 50]
    return out + ["".join(r.choice(parts) for _ in range(r.randrange(1, 40))) for _ in range(3000)]


def test_base_spans():
    for t in texts():
        assert P.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    P.base_spans("a" * 300_000 + " " + "1" * 300_000 + " " + "9" * 200_000 + ".1" + "+1" + "(" * 200_000 + "@" * 100_000)


def graph(features, chain, skip, label):
    g = P.Graph()
    n = len(features)
    g.doc, g.span, g.features, g.label, g.chain, g.skip = [0] * n, [(0, 1)] * n, features, label, chain, skip
    return g


def test_messages_are_exact_on_a_tree(monkeypatch):
    monkeypatch.setattr(P, "ROUNDS", 60)
    rng = np.random.default_rng(1)
    model = P.Model(rng.normal(size=(P.FEATURES, P.LABELS)), rng.normal(size=(P.LABELS, P.LABELS)),
                    (s := rng.normal(size=(P.LABELS, P.LABELS))) + s.T)
    n = 5
    features = [[int(x) for x in rng.integers(0, P.FEATURES, P.WIDTH)] for _ in range(n)]
    chain, skip, label = [(0, 1), (1, 2), (3, 4)], [(0, 3)], [0, 0, 2, 0, 0]
    got = model.marginals(graph(features, chain, skip, label))
    want = np.zeros((n, P.LABELS))
    unary = np.array([model.unary[f].sum(axis=0) for f in features])
    for ys in itertools.product(range(P.LABELS), repeat=n):
        if ys[2] != 2:
            continue
        s = sum(unary[i, y] for i, y in enumerate(ys) if i != 2)
        s += sum(model.chain[ys[a], ys[b]] for a, b in chain) + sum(model.skip[ys[a], ys[b]] for a, b in skip)
        for i, y in enumerate(ys):
            want[i, y] += np.exp(s)
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-5)


def test_skip_links_join_consecutive_occurrences():
    g = P.Graph()
    text = " ".join(f"word id77{i % 2}x9 word" for i in range(10))
    g.add(0, text, [])
    assert len(g.doc) == 10 and len(g.skip) == 8 and all(b - a == 2 for a, b in g.skip)


def corpus():
    r = random.Random(7)
    out = []
    for i in range(150):
        number = "".join(str(r.randrange(10)) for _ in range(10))
        phone = f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}"
        out.append(f"call {phone} or write to u{i}@mail{i % 7}.example.com from 10.{i}.2.3, order {r.randrange(10 ** 6)} of year {1990 + i % 30}")
    return out


def test_repeated_tokens_get_the_same_label(spark, docs):
    texts_ = corpus() + ["call +1 (415) 555-2671 or write ; later call 555-2671 or write",
                         "clean text with 12 numbers 345 and 6789 words", "12 12 12 345678901 345678901"]
    found = {r.doc_id: r for r in P.find(docs(texts_)).collect()}
    spans = found[150].spans
    assert [(s.kind, s.base) for s in spans if s.base] == [("phone", True)]
    added = [texts_[150][s.start:s.end] for s in spans if not s.base]
    assert added == ["555-2671"] and {s.kind for s in spans} == {"phone"}
    assert not found[151].spans and not found[152].spans
    for i, t in enumerate(texts_):
        base = [(P.KINDS.index(s.kind), s.start, s.end) for s in found[i].spans if s.base]
        assert base == brute(t)


def test_the_sample_counts_copies_once_and_stays_bounded(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(P, "train", lambda nodes: seen.append(nodes))
    P.fit(docs(corpus()).repartition(7), sample=60)
    P.fit(docs(corpus() + corpus()[:3] * 200).repartition(3), sample=60)
    assert len(seen[0]) == 60 and seen[0] == seen[1]
    P.fit(docs(["year 1999", "12", None, ""] * 30), sample=60)        # fewer nodes than asked for
    P.fit(docs([]))
    assert len(seen[2]) <= 60 and seen[3] == []


def test_masks_and_digests(spark, docs):
    t = ["x a@b.co y 1.2.3.4", "é\U0001F600 +1 234 567 890 z", None, "", "nothing", "1.2.3.4@b.co"]
    none = P.Model(np.zeros((P.FEATURES, P.LABELS)), np.zeros((P.LABELS,) * 2), np.zeros((P.LABELS,) * 2))
    df = P.find(docs(t), none)
    got = [r.m for r in df.orderBy("doc_id").select(P.masked().alias("m")).collect()]
    assert got == ["x <email> y <ip>", "é\U0001F600 <phone> z", None, "", "nothing", "<email>"]
    r = df.select("doc_id", *[c.alias(k) for k, c in P.digest_columns().items()]).orderBy("doc_id").collect()
    assert (r[0].n_email, r[0].n_ip, r[0].spans) == (1, 1, "email:2:8,ip:11:18")
    assert r[0].base_sha256 == hashlib.sha256(b"email:2:8,ip:11:18").hexdigest() and r[2].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_clashing_and_repeated(spark, docs):
    assert P.find(docs([])).count() == 0
    df = spark.createDataFrame([(None, "a@b.co", 5, "r"), (None, "a@b.co", 5, "r")], "doc_id long, text string, spans int, row string")
    rows = P.find(df).collect()
    assert len(rows) == 2 and all(len(r.spans) == 1 and r.row == "r" for r in rows)
    assert P.find(docs(["no personal data", None])).where(F.size("spans") > 0).count() == 0


def test_query_on_the_small_table(spark):
    texts_ = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op8(spark, SF_SMALL).collect():
        want = brute(texts_[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in want) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{P.KINDS[k]}:{a}:{z}" for k, a, z in want).encode()).hexdigest()
