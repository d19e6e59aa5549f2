"""Rules, their compiled columns, and held-out accuracy."""
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import quality as Q
from strata.llm.queries import op1
from tests.conftest import SF_ORACLE, SF_SMALL


def text_of(seed, bad):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(r.randrange(20, 120))]
    if bad == 1:
        words = [w + r.choice(["###", "&&&", "$$$"]) for w in words]
    if bad == 2:
        words = words[:2] * 40
    return " ".join(words)


def test_statistics_of_known_texts(spark, docs):
    rows = {r.doc_id: r for r in Q.statistics(docs([None, "", "A b\nA b ## 12|", "x" * 5000, "a a a b"])).collect()}
    assert all(getattr(rows[0], s) == getattr(rows[1], s) == 0.0 for s in Q.STATISTICS)
    r = rows[2]
    assert (r.longest, r.bars, r.doubled, r.distinct_words, r.distinct_lines) == (3.0, 1 / 6, 1 / 6, 4 / 6, 1.0)
    assert (r.upper, r.digits, r.symbols) == (2 / 14, 2 / 14, 2 / 14)
    assert rows[3].longest == 5000.0 and rows[4].repeats == 0.5 and rows[4].short_words == 1.0


def by_hand(text):
    """The 14 statistics, from their definitions."""
    import math
    import regex
    t = text or ""
    words = [w for w in re.split(r"[\x20\t-\r]+", t) if w]
    lines = [x for x in t.split("\n") if x]
    n, w, k = max(len(t), 1), max(len(words), 1), max(len(lines), 1)
    found = lambda p: len(regex.findall(p, t))
    return {"log_words": math.log1p(len(words)), "word_length": len(t) / w, "longest": max(map(len, words), default=0),
            "upper": found(r"\p{Lu}") / n, "symbols": found(r"[#&$%*=<>{}\[\]\\~^_@+/]") / n,
            "doubled": found(r"[^\p{L}\p{N}\s]{2,}") / w, "bars": t.count("|") / w, "digits": found("[0-9]") / n,
            "stops": found("[.,;:]") / w, "distinct_words": len(set(words)) / w,
            "repeats": sum(a == b for a, b in zip(words, words[1:])) / w, "distinct_lines": len(set(lines)) / k,
            "line_words": len(words) / k, "short_words": sum(len(x) <= 3 for x in words) / w}


def test_statistics_and_scores_by_hand(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = Q.learned(docs, labels)
    scores = {r.doc_id: r.score for r in Q.scored(docs, labels).collect()}
    assert model.rules and len(scores) == docs.count()
    for r in Q.statistics(docs).collect():
        want = by_hand(r.text)
        assert {s: getattr(r, s) for s in Q.STATISTICS} == pytest.approx(want)
        z = model.intercept + sum(weight for rule, weight in model.rules
                                  if all((getattr(r, s) <= x) == low for s, low, x in rule))
        assert scores[r.doc_id] == pytest.approx(1 / (1 + 2.718281828459045 ** -z))


def test_repeated_ids_and_labels_keep_the_bound(spark, docs, monkeypatch):
    texts = [text_of(i, i % 3) for i in range(60)] * 4
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] * 3, "doc_id long, quality int")
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda rows: (seen.append(rows.count()), fit(rows))[1])
    Q.learned(docs(texts, ids=list(range(60)) * 4), labels, sample=30)
    assert seen == [30]


def test_rules_simplify_and_compile(spark):
    rule = Q.simplified((("a", True, 5.0), ("a", True, 3.0), ("b", False, 1.0), ("b", False, 2.0)))
    assert rule == (("a", True, 3.0), ("b", False, 2.0))
    df = spark.createDataFrame([(3.0, 2.5), (3.1, 2.5), (3.0, 2.0)], "a double, b double")
    model = Q.RuleEnsemble(0.5, ((rule, 1.5), ((("a", False, 0.0),), -0.5)))
    got = [r[0] for r in df.select(model.score()).collect()]
    want = [1 / (1 + 2.718281828459045 ** -z) for z in (1.5, 0.0, 0.0)]
    assert got == pytest.approx(want)


def test_learns_from_the_training_part_only(spark, docs):
    n = 400
    bad = [(i * 7) % 5 if (i * 7) % 5 < 3 else 0 for i in range(n)]
    texts = [text_of(i, b) for i, b in enumerate(bad)]
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(n)]
    # labels of held-out rows are turned round: they must not matter
    rows = [(i, int((b == 0) != held[i])) for i, b in enumerate(bad)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.scored(docs(texts), labels).collect()}
    assert [got[i].held_out for i in range(n)] == held
    assert all(got[i].predicted == int(b == 0) for i, b in enumerate(bad))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_sample_is_bounded_and_model_sparse(spark, docs, monkeypatch):
    texts = [text_of(i, i % 3) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int")
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda rows: (seen.append(rows.count()), fit(rows))[1])
    model = Q.learned(docs(texts), labels, sample=100)
    assert seen == [100] and 0 < len(model.rules) < 120 and all(w for _, w in model.rules)


def test_no_labels_one_label_nulls_and_clashing_names(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.scored(docs(["a b", None]), none).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None)], "doc_id long, quality int")
    df = docs(["some words"] * 20).withColumn("score", F.lit("x")).withColumn("upper", F.lit(1)).withColumn("label", F.lit(0))
    got = Q.scored(df, ones).collect()
    assert len(got) == 20 and all(r.score > 0.99 and r.upper == 1 for r in got)
    assert Q.scored(docs([]), ones).count() == 0
    null_id = Q.scored(docs(["x", "x"], ids=[None, 5]), ones).collect()
    assert {r.doc_id: r.held_out for r in null_id}[None] is True


def test_held_out_accuracy(spark):
    rows = op1(spark, SF_ORACLE).join(
        spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    pairs = [(a.score, b.score) for a in rows for b in rows if a.quality > b.quality]
    assert sum((x > y) + 0.5 * (x == y) for x, y in pairs) >= 0.95 * len(pairs)


def test_fit_reads_its_sample_with_few_tasks(spark, monkeypatch):
    """However many partitions the labelled rows come in."""
    rows = spark.range(200).select((F.col("id") % 2).alias("label"), *[
        (F.col("id") % 2 * 5 + F.col("id") % 7).cast("double").alias(c) for c in Q.STATISTICS]).repartition(40)
    tasks, saved = [], Q.saved

    def counted(df):
        out = saved(df)
        tasks.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(Q, "saved", counted)
    assert Q.fit(rows).rules
    assert tasks == [40, Q.FIT_TASKS]
