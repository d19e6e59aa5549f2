"""The stages on a small corpus with known cases, and the registration."""
import random
import re

import corpus_pipeline
from strata.llm import queries
from tests.llm.test_ngram_join import brute as components_of
from tests.llm.test_pii import brute as personal


def corpus():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9)))
    clean = [" ".join(word() for _ in range(r.randrange(30, 90))) for _ in range(140)]
    junk = [" ".join(w + "###$$$" for w in t.split()) for t in clean[:60]]
    bench = [" ".join(word() for _ in range(22)) for _ in range(4)]
    near = [" ".join([*t.split()[:-1], "changed"]) for t in clean[60:80]]
    leaked = [clean[80 + i] + " " + bench[i % 4].upper() + " tail" for i in range(8)]
    personal_ = [clean[100 + i] + f" mail me{i}@site.example.org now" for i in range(8)]
    texts = clean + junk + near + leaked + personal_
    return texts, bench, range(140, 200), range(200, 220), range(220, 228), range(228, 236)


def test_every_stage_takes_effect(spark, docs, tmp_path):
    texts, bench, junk, near, leaked, mailed = corpus()
    docs(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in junk), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf, table = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet")
    left, kept = table, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf)
        left.write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == table.columns
        kept[name] = {r.doc_id: r.text for r in left.collect()}
    assert set(kept["quality"]) == set(range(len(texts))) - set(junk)
    component, _ = components_of([(i, t) for i, t in enumerate(texts) if i not in junk])
    assert set(kept["near_duplicates"]) == {i for i, c in component.items() if i == c}
    assert not set(kept["near_duplicates"]) & set(near)
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - set(leaked)
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    for i, t in kept["personal_data"].items():
        assert not personal(t)
        assert t == (re.sub(r"me\d+@site.example.org", "<email>", texts[i]) if i in mailed else texts[i])
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, sf).collect()
    assert {p.doc_id for p in pieces} == set(kept["personal_data"])
    whole = corpus_pipeline.run(spark, sf).collect()
    uncut = lambda rows: {p.doc_id: p.ids_crc32 for p in rows if p.length == p.doc_tokens}
    a, b = uncut(whole), uncut(pieces)
    assert len(set(a) & set(b)) > 10 and all(a[i] == b[i] for i in set(a) & set(b))
    assert sum(p.length for p in whole) == sum(p.length for p in pieces)


def test_null_and_repeated_ids(spark, docs, tmp_path):
    """Copies, near copies and benchmark passages among rows whose ids are null or repeated."""
    texts, bench, *_ = corpus()
    t, leak = texts, lambda k: texts[k] + " " + bench[k % 4] + " end"
    near = " ".join([*t[0].split()[:-1], "changed"])
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(5, t[0]), (None, t[0]), (None, near),                   # an id before null ones
            (None, t[1]), (None, t[1]), (None, t[1]),                # copies without ids: one stays
            (7, t[2]), (7, t[3]), (7, t[3]),                         # an id with two texts: both stay
            (None, ""), (None, ""), (None, None), (8, " "), (8, " "),    # without words: all stay
            (None, leak(20)), (None, t[4]), (9, leak(21)), (9, t[5])]
    table = docs([x for _, x in rows], [i for i, _ in rows])
    plain = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    once = [rows[k] for k in (0, 3, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16, 17)]
    kept = corpus_pipeline.deduplicate(spark, table, str(tmp_path))
    assert kept.columns == table.columns and plain(kept) == sorted(once, key=str)
    clean = corpus_pipeline.decontaminate(spark, table, str(tmp_path))
    assert clean.columns == table.columns and plain(clean) == sorted(rows[:14] + [rows[15], rows[17]], key=str)


def test_stages_take_empty_tables(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registration():
    import __spark_entry__ as E
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"] is corpus_pipeline.run and set(queries.ORACLE) <= set(E.oracle_sql())
