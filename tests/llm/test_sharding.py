import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm.queries import op7
from strata.llm.sharding import draw_counts, hypergeometric, uniform_shards
from tests.conftest import SF_SMALL


def test_counts_fill_rows_and_columns():
    m = draw_counts([30, 30, 29], [10, 0, 50, 29], [1])
    assert m.sum(axis=1).tolist() == [10, 0, 50, 29] and m.sum(axis=0).tolist() == [30, 30, 29] and (m >= 0).all()


def test_large_draws_have_the_hypergeometric_mean_and_spread():
    rng = np.random.default_rng(0)
    good, bad, n = 2_000_000_000, 6_000_000_000, 1_000_000
    x = np.array([hypergeometric(rng, good, bad, n) for _ in range(400)])
    assert abs(x.mean() - n / 4) < 4 * 433 / 20 and 0.85 < x.std() / 433 < 1.15
    assert hypergeometric(rng, 10 ** 10, 0, 7) == 7 and hypergeometric(rng, 0, 10 ** 10, 7) == 0


def test_every_row_gets_one_slot(spark):
    df = spark.range(0, 5003, 1, 7).withColumn("same", F.lit("x"))
    got = uniform_shards(df, 24, seed=3).collect()
    assert sorted(r.id for r in got) == list(range(5003))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 24
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    # neither the shard nor the slot follows the input
    x = np.array([(r.id, r.shard, r.slot) for r in got], float)
    assert abs(np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 0.06 and abs(np.corrcoef(x[:, 0], x[:, 2])[0, 1]) < 0.06
    again = uniform_shards(df, 24, seed=3).collect()
    assert {(r.id, r.shard, r.slot) for r in got} == {(r.id, r.shard, r.slot) for r in again}


def test_many_cells(spark, monkeypatch):
    import strata.llm.sharding as S
    monkeypatch.setattr(S, "CELL_ROWS", 10)
    got = uniform_shards(spark.range(0, 1000, 1, 3), 4).collect()
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(250))


def test_repeated_null_few_and_no_rows(spark):
    df = spark.createDataFrame([(None, None, 1)] * 30 + [(1, "a", 2)] * 20, "doc_id long, text string, shard long")
    got = uniform_shards(df, 24).collect()
    assert len(got) == 50 and max(Counter(r.shard for r in got).values()) == 3
    assert uniform_shards(df.limit(0), 24).count() == 0
    assert sorted((r.shard, r.slot) for r in uniform_shards(spark.range(3), 24).collect()) == [(0, 0), (1, 0), (2, 0)]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op7(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        b = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "rows", None)
