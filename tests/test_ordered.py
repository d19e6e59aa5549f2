"""Scans in order, sessions, interval joins, mergeable counts and samples."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from strata.operators import dims, growth, intervals, ordered, sample, visitors
from strata.sources import adapters as A
from strata.sources.readers import Tables
from strata.streaming import windows
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _partition_sizes(df, where):
    return [r.n for r in df.where(where).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.fixture()
def many_partitions(spark):
    """Small partitions stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ------------------------------------------------------- J6 next event

def _events(n=3000, seed=1, hot=0.4):
    r = random.Random(seed)
    return [(None if r.random() < 0.05 else "hot" if r.random() < hot else f"u{r.randrange(9)}",
             None if r.random() < 0.05 else r.randrange(n // 12), r.choice("abc"), r.choice([None, "x", "y"])) for _ in range(n)]


def _next_by_hand(events):
    out = []
    for u, t, a, b in events:
        later = [(s, a2, b2 is not None, b2) for u2, s, a2, b2 in events if u2 == u and t is not None and s is not None and s > t]
        n = min(later, default=None, key=lambda x: x[:3] + (x[3] or "",))
        out.append((u, t, a, b, *((n[0], n[1], n[3]) if n else (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, hot", [(1, 0.4), (2, 0.0), (3, 1.0)])
def test_next_event_equals_self_join(spark, many_partitions, seed, hot):
    events = _events(900, seed, hot)
    df = spark.createDataFrame(events, "u string, t long, a string, b string").repartition(5)
    assert rows(ordered.next_event(df, ["u"], "t", ["a", "b"])) == _next_by_hand(events)


def test_next_event_over_partitions_of_one_time(spark, many_partitions):
    # range partitions that hold a single time group, and keys that end at a border
    events = [("k", 5, str(i), None) for i in range(400)] + [("k", 6, "z", None), ("k", 4, "first", None), ("j", 9, "q", None)]
    df = spark.createDataFrame(events, "u string, t long, a string, b string")
    assert rows(ordered.next_event(df, ["u"], "t", ["a", "b"])) == _next_by_hand(events)
    assert ordered.next_event(df.limit(0), ["u"], "t", ["a", "b"]).count() == 0


def test_next_event_spreads_a_hot_user(spark, many_partitions):
    df = spark.createDataFrame(_events(4000, 5, 0.9), "u string, t long, a string, b string").repartition(6)
    sizes = _partition_sizes(ordered.next_event(df, ["u"], "t", ["a"]), "u = 'hot'")
    assert len(sizes) > 3 and max(sizes) < 0.5 * sum(sizes)


# ------------------------------------------------------- sequences and ranks

def test_sequence_with_null_keys_and_one_key_partitions(spark, many_partitions):
    r = random.Random(4)
    data = [(None if i % 7 == 0 else i % 3, None if i % 11 == 0 else "h" if i % 2 else "g", r.randrange(500), i, r.random())
            for i in range(3000)]
    df = spark.createDataFrame(data, "k long, s string, o long, id long, v double").repartition(5)
    got = ordered.keyed_sequence(df, ["k", "s"], [F.col("o"), F.col("id")], "n", running=["o", "v"])
    w = Window.partitionBy("k", "s").orderBy("o", "id")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.row_number().over(w), F.sum("o").over(up), F.sum("v").over(up))
    a, b = (sorted(map(tuple, d.collect())) for d in (got.select("id", "n", "o_cum", "v_cum"), want))
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert all(x[3] == pytest.approx(y[3]) for x, y in zip(a, b))


ORDER = [("a", "desc nulls last"), ("b", "asc nulls first")]
ORDER_SQL = "a DESC NULLS LAST, b ASC NULLS FIRST"


def test_ranks_with_half_of_all_rows_tied(spark, many_partitions):
    r = random.Random(6)
    data = [(i, *((1.5, "tied") if r.random() < 0.5 else (r.choice([None, float(r.randrange(40))]), r.choice([None, "x", "y"]))))
            for i in range(4000)]
    df = spark.createDataFrame(data, "id long, a double, b string").repartition(8)
    got = ordered.ranks(df, ORDER, "r")
    assert rows(got.select("id", "r")) == rows(df.selectExpr("id", f"CAST(RANK() OVER (ORDER BY {ORDER_SQL}) AS INT)"))
    sizes = _partition_sizes(got, "b = 'tied'")
    assert len(sizes) >= 8 and max(sizes) < 0.3 * sum(sizes)
    assert ordered.ranks(df.limit(0), ORDER, "r").count() == 0


# ------------------------------------------------------- T4 sessions

def _spark_sessions(df, gap):
    g = df.groupBy(F.session_window("t", gap).alias("s"), "ip", "host").agg(F.count(F.lit(1)).alias("n"))
    return g.select("s.start", "s.end", "ip", "host", "n")


@pytest.mark.parametrize("gap", ["5 minutes", "1 second", "90 minutes"])
def test_sessions_equal_session_window(spark, gap):
    r = random.Random(7)
    start = dt.datetime(2024, 3, 1)
    data = [("hot" if r.random() < 0.34 else None if r.random() < 0.1 else f"ip{r.randrange(20)}", r.choice(["h", None]),
             None if r.random() < 0.03 else start + dt.timedelta(seconds=r.choice([r.randrange(90000), 300 * r.randrange(300)]),
                                                               microseconds=r.choice([0, 0, 1, 999999])))
            for _ in range(3000)]
    df = spark.createDataFrame(data, "ip string, host string, t timestamp").repartition(4)
    assert rows(windows.sessionize(df, gap, ["ip", "host"], "t")) == rows(_spark_sessions(df, gap))


def test_a_hot_key_is_counted_per_time_slot(spark):
    t = F.timestamp_seconds(F.col("id") % 100_000)
    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ip"),
                                             F.lit("h").alias("host"), t.alias("t"))
    out = windows.sessionize(df, "5 minutes", ["ip", "host"], "t")
    assert [r.num_events for r in out.where("ip = 'hot'").collect()] == [20_000]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # events are aggregated by (key, slot); windows only see slots
    window = plan[plan.index("Window"):]
    assert "HashAggregate(keys=[ip" in window and "_slot" in window and "session_window" not in plan


# ------------------------------------------------------- J5 interval join

def test_cover_is_exact_and_short(spark):
    r = random.Random(8)
    pairs = [(0, 0), (0, 2**62), (5, 4), (None, 3), (7, 7), (1, 2**24), (0, 2**32 - 1)] + [
        tuple(sorted((r.randrange(300), r.randrange(300)))) for _ in range(60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, s long, e long")
    got = {x.i: x.c for x in df.select("i", intervals.dyadic_cover(F.col("s"), F.col("e")).alias("c")).collect()}
    for i, (s, e) in enumerate(pairs):
        if s is None or s > e:
            assert not got[i]
            continue
        blocks = sorted((b.block << b.level, (b.block + 1) << b.level) for b in got[i])
        assert blocks[0][0] == s and blocks[-1][1] == e + 1 and all(a[1] == b[0] for a, b in zip(blocks, blocks[1:]))
        assert len(blocks) <= 2 * (e - s + 1).bit_length()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_equals_between(spark, how):
    r = random.Random(9)
    points = [(i, None if r.random() < 0.05 else r.randrange(1 << 20)) for i in range(400)]
    ranges = [(f"r{i}", a, a + r.choice([0, 5, 255, 3000, 1 << 18, -4])) for i, a in enumerate(r.randrange(1 << 20) for _ in range(60))]
    ranges += [("all", 0, 1 << 40), ranges[0], ("null", None, 5)]
    p, g = spark.createDataFrame(points, "id long, x long"), spark.createDataFrame(ranges, "name string, start long, end long")
    got = intervals.interval_join(p, g, "x", how=how)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(got) == rows(p.join(g, F.col("x").between(F.col("start"), F.col("end")), how))
    assert intervals.interval_join(p, g.limit(0), "x", how=how).count() == (400 if how == "left" else 0)


# ------------------------------------------------------- A2 visitors, L7 samples

def test_visitor_states_add_up(spark):
    ev = A.web_events(Tables(spark, SF_SMALL))
    ev = ev.withColumn("user_id", F.when(F.col("user_id") % 5 == 0, F.col("user_id") * 1_000_003).otherwise(F.col("user_id")))
    old, new = (visitors.daily_states(ev.where(c), ["host"]) for c in ("user_id % 2 = 0", "user_id % 2 = 1"))
    for period in (F.trunc("day", "month"), F.lit("ever"), F.col("day")):
        want = ev.where("user_id IS NOT NULL").withColumn("day", F.to_date("event_time")).groupBy("host", period.alias("period")).agg(
            F.count_distinct("user_id").alias("unique_users"))
        assert rows(visitors.unique_over(visitors.merge_states(old, new), ["host"], period)) == rows(want)


def test_sample_is_exact_and_repeats(spark):
    data = [(i % 4000, i, f"v{i}") for i in range(12_000)] + [(None, 5, "n")]
    df = spark.createDataFrame(data, "k long, a long, b string")
    first = rows(sample.sample_keys(df.repartition(40), ["k"], 100))
    assert first == rows(sample.sample_keys(df.repartition(3), ["k"], 100)) and len({r[0] for r in first}) == 100
    hashes = {r.k: r.h for r in df.select("k", sample.key_hash(["k"]).alias("h")).distinct().collect()}
    assert {r[0] for r in first} == set(sorted(hashes, key=lambda k: hashes[k])[:100])
    best = {}
    for k, a, b in data:
        best[k] = min(best.get(k, (a, b)), (a, b))
    assert all((a, b) == best[k] for k, a, b in first)
    assert sample.sample_keys(df, ["k"], 10_000).count() == 4001 and sample.sample_keys(df.limit(0), ["k"], 5).count() == 0


def test_no_task_ranks_k_rows_of_each_partition(spark):
    """What is left to rank is about 2k rows however many partitions there are."""
    k = 200
    for partitions in (1, 1000):
        df = spark.range(0, 1_000_000, 1, partitions).select((F.col("id") % 200_000).alias("k"))
        distinct = df.agg(F.approx_count_distinct(sample.key_hash(["k"]), 0.02)).first()[0]
        bound = int(sample.RANGE * (2 * k + 100) / distinct)
        left = df.where(sample.key_hash(["k"]) < bound).distinct().count()
        assert k <= left < 3 * k


# ------------------------------------------------------- D3/D4 chunks, D25 lists

def test_chunks_bound_a_hot_entity(spark):
    hot = spark.range(0, 6000).select(F.lit("Hot").alias("actor"), F.lit(1).cast("bigint").alias("actorid"),
                                      F.concat(F.lit("f"), "id").alias("film"), F.concat(F.lit("f"), "id").alias("filmid"),
                                      F.lit(2000).cast("bigint").alias("year"), (F.col("id") % 7).alias("votes"),
                                      (F.col("id") % 10).cast("double").alias("rating"))
    films = A.actor_films(Tables(spark, SF_SMALL)).select(*hot.columns).unionByName(hot)
    chunks = dims.film_chunks(films, 100)
    sizes = [r.n for r in chunks.where("actorid = 1 AND year = 2000").select(F.size("films").alias("n")).collect()]
    assert sum(sizes) >= 6000 and max(sizes) < 160 and len(sizes) >= 60
    back = chunks.select("actorid", "year", F.inline("films"))
    assert rows(back.select("actorid", "year", "film", "votes", "rating", "filmid")) == \
        rows(films.select("actorid", "year", "film", "votes", "rating", "filmid"))
    refs = dims.actor_references(films, 2001, 100)
    assert max(len(str(r)) for r in refs.where("actorid = 1").collect()) < 2000
    so_far = dims.films_so_far(refs, chunks).where("actorid = 1 AND current_year = 2001")
    assert so_far.select(F.sum(F.size("films"))).first()[0] == films.where("actorid = 1 AND year <= 2001").count()


def test_snapshot_equals_daily_steps(spark):
    ev = A.web_events(Tables(spark, SF_SMALL))
    first = ev.agg(F.to_date(F.min("event_time"))).first()[0]
    step = None
    for i in range(9):
        day = (first + dt.timedelta(days=i)).isoformat()
        step = growth.growth_accounting_step(step, ev, day).checkpoint()
    ordered_list = step.withColumn("dates_active", F.array_sort("dates_active"))
    assert rows(growth.growth_accounting_snapshot(ev, day).select(*growth.GA_COLS)) == rows(ordered_list.select(*growth.GA_COLS))
