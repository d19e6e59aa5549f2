"""Trigram queries are necessary conditions; spans equal a full scan."""
import hashlib
import random
import re

import duckdb

from strata.llm import secrets as S
from strata.llm.queries import op4
from tests.conftest import SF_SMALL


def python_spans(text):
    out = []
    for order, rule in enumerate(S.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), order, m.end(), rule.kind))
    return sorted(out)


def texts():
    r = random.Random(6)
    out = [None, "", " ", "password", "token=12345678", "TOKEN = 'abcdefgh'", "password: secret: abcdefghij", "api_key:\"aaaaaaaa\"",
           "apikey=short apikey=longenough1", "xAKIA" + "A" * 12 + " AKIAAAAAAAAAAAA", "AKIA" * 8, "é\U0001F600 secret:=x secret=éabcdefgh",
           "f" * 31 + "g" + "0" * 32 + "z" + "ab" * 40, "-----BEGIN RSA PRIVATE KEY----- -----BEGIN PRIVATE KEY-----",
           "ghp_" + "a" * 36, "xoxb-" + "1" * 12, "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9,
           "token=aaaaaaaa token=bbbbbbbb token=c token=dddddddd", "secret = " + "x" * 3000]
    parts = ["password", "PassWd", "secret", "token", "api", "_", "key", "=", ":", " ", "'", '"', "AKIA", "abcdef01", "deadbeef", "é", "X9", "\n", "=="]
    out += ["".join(r.choice(parts) for _ in range(r.randrange(1, 60))) for _ in range(300)]
    return out


def test_query_of_known_patterns():
    q = lambda *alts: frozenset(frozenset(a.split()) for a in alts)
    assert S.trigram_query("AKIA[A-Z0-9]+") == q("aki kia")
    assert S.trigram_query("(?i:abcd|xyz)") == q("abc bcd", "xyz")
    assert S.trigram_query("[0-9a-f]{32,}") == S.EVERY
    assert S.trigram_query("ab?c") == S.EVERY                   # "ac" has no trigram
    assert S.trigram_query("abc(?:def)*xyz") == q("abc xyz")
    assert S.trigram_query("abc[xy]") == q("abc bcx", "abc bcy")
    assert S.trigram_query("a[0-9]b") == S.EVERY
    assert S.trigram_query("(?:abc)+q") == q("abc")


def test_every_match_meets_its_query():
    for rule in S.RULES:
        query = S.trigram_query(rule.pattern)
        for t in texts():
            for m in re.finditer(rule.pattern, t or "", re.ASCII):
                low = m.group().lower()
                assert any(all(g in low for g in alt) for alt in query)


def test_spans_equal_a_full_scan(spark, docs):
    all_texts = texts()
    got = {r.doc_id: [tuple(x) for x in r.secrets] for r in S.scan(docs(all_texts)).collect()}
    for i, t in enumerate(all_texts):
        assert got[i] == python_spans(t), t


def test_only_candidates_are_verified(spark, docs):
    queries = {r.kind: S.trigram_query(r.pattern) for r in S.RULES if S.trigram_query(r.pattern) != S.EVERY}
    grams = sorted({g for q in queries.values() for a in q for g in a})
    df = docs(["pass the word", "a PASSWORD here", "nothing", None, "a PASSWORD here"])
    found = S.candidates(S.postings(df, grams), queries).collect()
    assert [r.kinds for r in found] == [["assign"]]            # equal texts share a candidate


def test_digest_columns_repeats_and_clashing_names(spark):
    text = "token = abcdefgh12345678 " + "a1" * 16
    df = spark.createDataFrame([(1, text, ["x"], "k", 2)] * 3, "doc_id long, text string, secrets array<string>, text_key string, kinds int")
    found = S.scan(df)
    assert found.columns == ["doc_id", "text", "text_key", "kinds", "secrets"]
    rows = found.select("doc_id", *[c.alias(k) for k, c in S.digest_columns().items()]).collect()
    listed = f"assign:0:24,hex:25:{25 + 32}"
    assert len(rows) == 3 and {r.spans for r in rows} == {listed}
    assert {(r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows} == {(1, 0, 1, hashlib.sha256(listed.encode()).hexdigest())}
    assert S.scan(df.limit(0)).count() == 0


def test_oracle_on_hard_texts(spark, docs):
    rows = docs(texts())
    got = sorted(map(str, rows.transform(S.scan).select("doc_id", *[c.alias(k) for k, c in S.digest_columns().items()]).collect()))
    con = duckdb.connect()
    documents = rows.toPandas()  # noqa: F841  read by name below
    want = con.execute(S.oracle_sql()).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, (tuple(r) for r in want))) == sorted(
        str(tuple(r[n] for n in names)) for r in rows.transform(S.scan).select(
            "doc_id", *[c.alias(k) for k, c in S.digest_columns().items()]).collect()) and len(got) == len(want)


def test_query_on_the_small_table(spark):
    texts_ = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op4(spark, SF_SMALL).collect():
        want = python_spans(texts_[r.doc_id])
        assert r.spans == ",".join(f"{k}:{a}:{z}" for a, _, z, k in want)
        base = ",".join(f"{k}:{a}:{z}" for a, o, z, k in want if o < 3)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
