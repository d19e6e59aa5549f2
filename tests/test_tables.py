"""Tables that are written and read back: keyed maintenance, bucketed joins,
measured broadcasts, layouts, batches written once."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import relational as R
from strata.plans import table_queries as Q
from strata.sources import layouts
from strata.sources.keyed_tables import BUCKET, KeyedTable
from strata.sources.readers import Tables
from strata.streaming import sinks as stream_sinks
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


# ------------------------------------------------------- S6-S8

def _table(spark, path, n=200, buckets=16):
    df = spark.range(n).select("id", (F.col("id") * 2).alias("v"), F.lit(None).cast("date").alias("ended"), F.lit(True).alias("open"))
    return KeyedTable(spark, str(path), ["id"], buckets).create(df)


BATCH = "id long, v long, ended date, open boolean"


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    table = _table(spark, tmp_path / "t")
    batch = spark.createDataFrame([(3, -1, None, True), (1000, -2, None, True)], BATCH)
    before = files(tmp_path)
    want = {i: 2 * i for i in range(200)} | {3: -1, 1000: -2}
    for _ in range(2):                                    # a re-run gives the same table
        table.upsert(batch)
        assert {r.id: r.v for r in table.read().collect()} == want and table.read().count() == 201
    after = files(tmp_path)
    kept = {f for f in before if after.get(f) == before[f]}
    buckets = {f.split(f"{BUCKET}=")[1].split("/")[0] for f in set(before) - kept}
    assert 1 <= len(buckets) <= 2 and len(kept) == len(before) - len(buckets)


def test_insert_ignore_and_close(spark, tmp_path):
    table = _table(spark, tmp_path / "t", 20, 4)
    table.insert_ignore(spark.createDataFrame([(3, -1, None, True), (50, 7, None, True)], BATCH))
    assert {r.id: r.v for r in table.read().collect()} == {i: 2 * i for i in range(20)} | {50: 7}
    import datetime as dt
    for _ in range(2):
        table.close(spark.createDataFrame([(3,), (99,)], "id long"), "ended", dt.date(2024, 1, 1), "open")
    assert [tuple(r) for r in table.read().where("NOT open").collect()] == [(3, 6, dt.date(2024, 1, 1), False)]
    assert table.read().count() == 21


def test_empty_batch_and_null_keys(spark, tmp_path):
    table = _table(spark, tmp_path / "t", 5, 2)
    before = files(tmp_path)
    table.upsert(spark.createDataFrame([], BATCH))
    assert files(tmp_path) == before
    table.upsert(spark.createDataFrame([(None, 1, None, True)], BATCH))    # null is no key that equals another
    assert table.read().where("id IS NULL").count() == 1


# ------------------------------------------------------- S10, J10-J12

def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_bucketed_join_has_no_exchange_and_plain_join_two(spark):
    t = Tables(spark, SF_SMALL)
    bucketed, plain = Q.j11_bucketed_join(t), Q.j12_plain_join(t)
    p, q = _plan(bucketed), _plan(plain)
    assert "Exchange" not in p and "SortMergeJoin" in p and "SelectedBucketsCount" in p
    assert q.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in q
    assert rows(bucketed) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_broadcast_within_the_budget_only(spark, how):
    left = spark.range(0, 1000).select((F.col("id") % 70).alias("k"), "id")
    small = spark.range(0, 50).select(F.col("id").alias("k"), F.concat(F.lit("name"), "id").alias("name"))
    size = R.measured_bytes(small)
    assert 50 * 10 < size < 50 * 40
    within, beyond = R.sized_join(left, small, "k", how, size), R.sized_join(left, small, "k", how, size - 1)
    assert "BroadcastHashJoin" in _plan(within)
    assert "BroadcastHashJoin" not in _plan(beyond) and "SortMergeJoin" in _plan(beyond)
    assert rows(within) == rows(beyond)
    assert R.measured_bytes(small.limit(0)) == 0


# ------------------------------------------------------- L5

def test_z_order_prunes_on_both_columns(spark, tmp_path):
    df = spark.range(0, 40_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104729 % 997).alias("b"), "id")
    df = df.unionByName(spark.createDataFrame([(None, 5, -1)], "a long, b long, id long"))
    tie = F.xxhash64("a", "b", "id")
    zed = layouts.with_zorder(df, ["a", "b"])
    paths = {n: str(tmp_path / n) for n in ("spread", "by_a", "z")}
    layouts.write_layout(df, paths["spread"], [tie], 16)
    layouts.write_layout(df, paths["by_a"], [F.col("a"), tie], 16)
    layouts.write_layout(zed, paths["z"], [F.col("z"), tie], 16)
    groups = layouts.row_groups(spark, paths, ["a", "b"])
    share = {(r.layout, r.column): r.share for r in layouts.read_share(groups, df, ["a", "b"]).collect()}
    assert all(r.n == 40_001 for r in groups.groupBy("layout", "column").agg(F.sum("num_rows").alias("n")).collect())
    assert share["spread", "a"] > 0.95 and share["spread", "b"] > 0.95
    assert share["by_a", "a"] < 0.2 and share["by_a", "b"] > 0.95
    assert share["z", "a"] < 0.5 and share["z", "b"] < 0.5


# ------------------------------------------------------- T8

def test_a_stopped_batch_is_there_once_in_both_sinks(spark, tmp_path):
    src, out = str(tmp_path / "in"), stream_sinks.BatchFiles(str(tmp_path / "out"))
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).select("id", (F.col("id") % 2).alias("side")).coalesce(1).write.mode("append").parquet(src)
    fail = {"left": 1}

    def write(name, df, batch_id):
        out.write(name, df, batch_id)
        if name == "ids" and batch_id == 1 and fail["left"]:
            fail["left"] -= 1
            raise RuntimeError("stopped between two sinks")

    writers = {"ids": lambda b: b.select("id"), "sides": lambda b: b.groupBy("side").count()}

    def run():
        q = (spark.readStream.schema("id long, side long").option("maxFilesPerTrigger", 1).parquet(src).writeStream
             .foreachBatch(stream_sinks.multi_sink(writers, write, out.finished))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()

    with pytest.raises(Exception, match="stopped between two sinks"):
        run()
    seen = out.read(spark, "ids", "id long")
    assert seen.select("batch_id").distinct().count() == 1          # the half-written batch does not count yet
    run()
    assert sorted(r.id for r in out.read(spark, "ids", "id long").collect()) == list(range(30))
    sides = out.read(spark, "sides", "side long, count long").groupBy("side").agg(F.sum("count").alias("n"))
    assert rows(sides) == [(0, 15), (1, 15)]
