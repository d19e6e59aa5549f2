"""Writers, table maintenance and physical layout."""

import os

from pyspark.sql import functions as F

from strata.operators import arrays, relational as R
from strata.sources import sinks


def test_bucketed_join_has_no_exchange(spark):
    a = spark.range(0, 2000).select(F.col("id").alias("match_id"), (F.col("id") % 7).alias("x"))
    b = spark.range(0, 2000).select(F.col("id").alias("match_id"), (F.col("id") % 5).alias("y"))
    sinks.write_bucketed(a, "mb_a", 16, "match_id", ["match_id"])
    sinks.write_bucketed(b, "mb_b", 16, "match_id", ["match_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("mb_a").join(spark.table("mb_b"), "match_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_snapshot_is_idempotent(spark, tmp_path):
    p = str(tmp_path / "snap")
    d1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "k long, ds string")
    d2 = spark.createDataFrame([(3, "2024-01-02")], "k long, ds string")
    sinks.append_snapshot(d1, p)
    sinks.append_snapshot(d2, p)
    sinks.append_snapshot(d2, p)
    assert sorted(r.k for r in spark.read.parquet(p).collect()) == [1, 2, 3]


def test_overwrite_into_reorders_by_name(spark):
    spark.sql("CREATE TABLE oi (a BIGINT, b STRING) USING parquet")
    sinks.overwrite_into(spark.createDataFrame([("x", 1)], "b string, a long"), "oi")
    assert [tuple(r) for r in spark.table("oi").collect()] == [(1, "x")]


def test_upsert_insert_ignore_close_rows(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, arrays.upsert(tgt, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, arrays.insert_ignore(tgt, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "C")]
    scd = spark.createDataFrame([(1, None, True), (2, None, True)], "k long, end_date string, cur boolean")
    out = sinks.close_rows(scd, spark.createDataFrame([(2,)], "k long"), ["k"], "end_date", "2020-12-31", "cur")
    assert sorted(map(tuple, out.collect())) == [(1, None, True), (2, "2020-12-31", False)]


def test_sorted_layout_is_smaller_and_reported(spark, tmp_path):
    df = spark.range(0, 200000).select((F.col("id") % 13).alias("k"),
                                       (F.col("id") * 7919 % 1000).alias("v"),
                                       F.lit("2024").alias("year")).orderBy(F.xxhash64("id"))
    u, s = str(tmp_path / "unsorted"), str(tmp_path / "sorted")
    sinks.write_partitioned(df, u, ["year"], n=4)
    sinks.write_partitioned(df, s, ["year"], sort_within=["k", "v"], n=4)
    rep = {r.table: (r.total_bytes, r.num_files) for r in
           sinks.file_layout_report(spark, {"unsorted": u, "sorted": s}).collect()}
    assert rep["sorted"][0] < rep["unsorted"][0]


def test_global_rank_matches_window_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") * 37 % 101).alias("v"), F.col("id"))
    got = R.global_rank(df.repartition(7), [("v", "desc")], name="r")
    ref = df.selectExpr("id", "rank() OVER (ORDER BY v DESC) AS r")
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, ref.collect()))


def test_keyed_sequence_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
        (F.col("id") * 7919 % 1009).alias("o"), (F.col("id") % 5).alias("v"), "id")
    got = R.keyed_sequence(df.repartition(5), ["k"], [F.col("o"), F.col("id")], "s", running="v")
    w = Window.partitionBy("k").orderBy("o", "id")
    ref = df.select("id", F.row_number().over(w).alias("s"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v_cum"))
    assert sorted(map(tuple, got.select("id", "s", "v_cum").collect())) == \
        sorted(map(tuple, ref.collect()))


def test_cached_two_phase_aggregate(spark):
    from strata.operators import jobs
    from strata.sources import adapters as A
    from strata.sources.readers import Tables
    from tests.conftest import SF_SMALL
    t = Tables(spark, SF_SMALL)
    ev = A.web_events(t)
    with R.cached(jobs.events_per_user_device(ev)) as agg:
        users = ev.where(F.col("user_id").isNotNull()).select("user_id").distinct()
        a = jobs.users_and_devices(agg, users).count()
        b = jobs.devices_on_events(agg, A.devices(t)).count()
        assert agg.is_cached
    assert a > 0 and b > 0 and not agg.is_cached


def test_csv_table_roundtrip(spark, tmp_path):
    from strata.sources import readers
    csv = tmp_path / "maps.csv"
    csv.write_text("mapid,name,description\nm1,Alpha,first\nm2,,no name\nm3,Gamma ,\n")
    df = readers.read_csv(spark, str(csv), "mapid string, name string, description string")
    named = df.where(F.col("name").isNotNull())
    assert sorted(r.mapid for r in named.collect()) == ["m1", "m3"]
    sinks.write_table(named, "maps_named")
    readers.register_views(spark, {"maps_v": readers.read_table(spark, "maps_named")})
    assert spark.sql("SELECT count(*) AS n FROM maps_v").collect()[0].n == 2
    raw = readers.read_csv(spark, str(csv))              # no schema: all strings, no inference
    assert all(t == "string" for _, t in raw.dtypes)


def test_job_entry_point_writes_result(spark, tmp_path):
    from strata.__main__ import main
    from tests.conftest import SF_SMALL
    out = str(tmp_path / "funnel_out")
    assert main(["d27_funnel", SF_SMALL, out]) == 0
    assert spark.read.parquet(out).columns == ["url", "num_units", "conversion_rate"]
