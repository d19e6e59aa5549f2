"""Signatures, likeness and neighbours against plain Python."""
import hashlib
import re

from pyspark.sql import functions as F

from strata.llm import spotsigs as S
from tests.conftest import SF_SMALL

ANCHORS = {w for words in S.ANCHORS.values() for w in words.split()}


def sigs(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    if not any(x in ANCHORS for x in w):
        return {":" + " ".join(w)} if w else set()
    out = set()
    for i, x in enumerate(w):
        if x in ANCHORS:
            chain, stretches = [], 1
            for y in w[i + 1:]:
                if y in ANCHORS:
                    stretches += 1
                    if stretches > S.REACH:
                        break
                else:
                    chain.append(y)
                if len(chain) == S.CHAIN:
                    break
            out.add(" ".join([x, *chain]))
    return out


def like(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def check(df, rows):
    """rows: (id, text) in the order of the table."""
    ring = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t) in enumerate(ring):
        t, nxt = t or "", ring[(k + 1) % len(ring)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), len(sigs(t)), len(sigs(edited)),
                     round(like(sigs(t), sigs(edited)), 9), round(like(sigs(t), sigs(nxt)), 9)))
    got = [(r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), len(r.fingerprint) // 8,
            len(r.edited_fingerprint) // 8, round(r.near_edited, 9), round(r.near_next, 9)) for r in S.compared(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    prints = {}
    for r in S.compared(df).collect():
        prints.setdefault(r.fingerprint, set()).add(frozenset(sigs(dict(rows).get(r.doc_id))))


def test_small_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_blocks_gaps_nulls_and_short_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 3)
    texts = [None, "", "the", "the cat", "the of and to cat sat", "the of and to in is cat", "no anchors_here!", "é É the à ê",
             "\U0001F600\U0001F600 the \U0001F600", "the cat sat on the mat and the dog ran to a tree", "x" * 3000] * 2
    ids = [3, 900, 7, 10 ** 12, 5, 6, 11, 12, 400, 401, 402, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23]
    check(docs(texts, ids=ids), list(zip(ids, texts)))


def test_single_repeated_null_and_no_rows(spark, docs):
    one = S.compared(docs(["the cat sat here"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited == "the cat the cat "
    same = S.compared(docs(["the cat sat"] * 3, ids=[4, 4, 4])).collect()
    assert len(same) == 3 and len({r.fingerprint for r in same}) == 1
    nulls = S.compared(docs(["the cat", "the dog", None], ids=[None, 1, None])).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in nulls) == [("1", 7), ("None", 0), ("None", 7)]
    assert S.compared(docs([])).count() == 0


def test_length_pruning_never_changes_a_likeness_over_the_threshold(spark):
    sets = [[], [1], [2], list(range(8)), list(range(2, 12)), list(range(9)), list(range(100, 110)), list(range(40))]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<long>, b array<long>")
    rows = df.select("a", "b", S.jaccard(F.col("a"), F.col("b")).alias("full"),
                     S.jaccard(F.col("a"), F.col("b"), 0.6).alias("pruned")).collect()
    for r in rows:
        assert abs(r.full - like(set(r.a), set(r.b))) < 1e-12
        assert r.pruned == r.full or (r.full < 0.6 and r.pruned == 0.0)
