"""Edge cases listed as "Added" in FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import arrays, graph, growth, scd

D = dt.date.fromisoformat


def _ev(spark, rows):
    return spark.createDataFrame(
        [(u, dt.datetime.fromisoformat(t), url, "h") for u, t, url in rows],
        "user_id long, event_time timestamp_ntz, url string, host string")


def test_growth_state_ladders(spark):
    # prev snapshot on 2024-01-09 with one user per branch
    prev = spark.createDataFrame([
        (1, D("2024-01-01"), D("2024-01-09"), [D("2024-01-09")], D("2024-01-09")),  # active yesterday
        (2, D("2024-01-01"), D("2024-01-05"), [D("2024-01-05")], D("2024-01-09")),  # gap of days
        (3, D("2024-01-01"), D("2024-01-09"), [D("2024-01-09")], D("2024-01-09")),  # churns today
        (4, D("2024-01-01"), D("2024-01-02"), [D("2024-01-02")], D("2024-01-09")),  # stale / weekly churn
        (5, D("2023-12-01"), D("2023-12-20"), [D("2023-12-20")], D("2024-01-09")),  # weekly resurrected
        (6, D("2024-01-01"), D("2024-01-04"), [D("2024-01-04")], D("2024-01-09")),  # stale, weekly retained
    ], "user_id long, first_active_date date, last_active_date date, dates_active array<date>, date date")
    ev = _ev(spark, [(1, "2024-01-10 08:00:00", "/"), (2, "2024-01-10 09:00:00", "/"),
                     (5, "2024-01-10 09:00:00", "/"), (7, "2024-01-10 10:00:00", "/")])
    out = {r.user_id: (r.daily_active_state, r.weekly_active_state, r.date)
           for r in growth.growth_accounting_step(prev, ev, "2024-01-10").collect()}
    d = D("2024-01-10")
    assert out[1] == ("Retained", "Retained", d)
    assert out[2] == ("Resurrected", "Retained", d)
    assert out[3] == ("Churned", "Retained", d)
    assert out[4] == ("Stale", "Churned", d)
    assert out[5] == ("Resurrected", "Resurrected", d)
    assert out[6] == ("Stale", "Retained", d)
    assert out[7] == ("New", "New", d)


def test_growth_step_takes_yesterday_only_and_each_day_once(spark):
    ev = _ev(spark, [(1, "2024-01-10 08:00:00", "/")])
    s1 = growth.growth_accounting_step(None, ev, "2024-01-10")
    assert [len(r.dates_active) for r in s1.collect()] == [1]
    # a day that is already in the list is not appended again
    again = growth.growth_accounting_step(s1.withColumn("date", F.date_sub("date", 1)), ev, "2024-01-10")
    assert [r.dates_active for r in again.collect()] == [[D("2024-01-10")]]
    # older snapshots in the same table are not joined
    two = s1.withColumn("date", F.date_sub("date", 1)).unionByName(s1.withColumn("date", F.date_sub("date", 5)))
    assert growth.growth_accounting_step(two, ev, "2024-01-10").count() == 1


def test_scd_backfill_unchanged_last_year_and_null_class(spark):
    df = spark.createDataFrame(
        [(1, "a", 2000, "good", True), (1, "a", 2001, "good", True), (1, "a", 2002, "good", True),
         (2, "b", 2000, None, True), (2, "b", 2001, None, True), (2, "b", 2002, "bad", True)],
        "actorid long, actor string, year long, quality_class string, is_active boolean")
    got = sorted(((r.actorid, r.quality_class, r.start_date, r.end_date, r.current_flag) for r in
                  scd.scd2_backfill(df, "actorid", "year", ["quality_class", "is_active"],
                                    extra=["actor"]).collect()), key=lambda x: (x[0], x[2]))
    assert got == [(1, "good", D("2000-01-01"), None, True),
                   (2, None, D("2000-01-01"), D("2001-12-31"), False),
                   (2, "bad", D("2002-01-01"), None, True)]


def test_metric_array_skipped_day_is_a_gap_not_a_shift(spark):
    ev = _ev(spark, [(1, "2024-01-01 08:00:00", "/"), (1, "2024-01-03 08:00:00", "/"),
                     (1, "2024-01-03 09:00:00", "/")])
    d1 = arrays.metric_step(None, ev, ["user_id"], "2024-01-01", None, name="a")
    d3 = arrays.metric_step(d1, ev, ["user_id"], "2024-01-03", None, name="a")   # day 2 skipped
    again = arrays.metric_step(d3, ev, ["user_id"], "2024-01-03", None, name="a")
    assert [r.a for r in d3.collect()] == [[1, None, 2]]
    assert [r.a for r in again.collect()] == [[1, None, 2]]


def test_funnel_timing_edges(spark):
    rows = []
    # user 1: target at the same instant as /a -> not a later event; no conversion
    rows += [(1, "2024-01-01 10:00:00", "/a"), (1, "2024-01-01 10:00:00", "/signup"),
             (1, "2024-01-01 11:00:00", "/b")]
    # user 2: target only before /a -> /a does not convert
    rows += [(2, "2024-01-01 09:00:00", "/signup"), (2, "2024-01-01 10:00:00", "/a"),
             (2, "2024-01-01 12:00:00", "/c")]
    # user 3: /a then target later the same day -> converts; next-day target does not count
    rows += [(3, "2024-01-01 10:00:00", "/a"), (3, "2024-01-01 10:30:00", "/signup"),
             (3, "2024-01-02 10:00:00", "/a"), (3, "2024-01-03 10:00:00", "/signup")]
    ev = _ev(spark, rows)
    ev = ev.unionByName(ev.withColumn("host", F.lit("h2")))   # two hosts for one moment
    out = {r.url: (r.num_units, r.conversion_rate)
           for r in growth.funnel(ev, "/signup", min_rows=-1).collect()}
    assert out["/a"] == (3, 1 / 3)


def test_player_pairs_same_name_two_ids(spark):
    d = spark.createDataFrame(
        [(1, 10, "T1", 100, "Same", 1, 5, 0, 0), (1, 10, "T1", 200, "Same", 2, 7, 0, 0),
         (1, 20, "T2", 300, "Other", 3, 9, 0, 0)],
        "game_id long, team_id long, team_abbreviation string, player_id long, player_name string, "
        "start_position_no long, pts long, reb long, ast long")
    e = {(r.subject_player_id, r.object_player_id, r.edge_type) for r in
         graph.player_player_edges(d).collect()}
    # equal names are excluded, like the source's name inequality
    assert e == {(300, 100, "plays_against"), (300, 200, "plays_against")}


def test_scd2_incremental_branches(spark):
    prev = spark.createDataFrame(
        [("old", "bad", True, 2000, 2018, 2021),       # history closed before last season
         ("same", "good", True, 2019, 2021, 2021),     # unchanged -> extended
         ("chg", "good", True, 2020, 2021, 2021),      # class changes -> old row + new row
         ("gone", "star", True, 2015, 2021, 2021)],    # absent this season -> kept as is
        "player_name string, scoring_class string, is_active boolean, start_season long, "
        "end_season long, current_season long")
    cur = spark.createDataFrame(
        [("same", "good", True, 2022), ("chg", "bad", True, 2022), ("new", "star", True, 2022)],
        "player_name string, scoring_class string, is_active boolean, current_season long")
    out = scd.scd2_incremental(prev, cur, "player_name", ["scoring_class", "is_active"], 2022)
    got = sorted((r.player_name, r.scoring_class, r.start_season, r.end_season, r.current_season)
                 for r in out.collect())
    assert got == [("chg", "bad", 2022, 2022, 2022), ("chg", "good", 2020, 2021, 2022),
                   ("gone", "star", 2015, 2021, 2022), ("new", "star", 2022, 2022, 2022),
                   ("old", "bad", 2000, 2018, 2022), ("same", "good", 2019, 2022, 2022)]
