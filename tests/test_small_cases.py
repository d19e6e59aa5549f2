"""Small cases with rows of our own: streaks, positional sums, dedupe, ranking,
monthly activity."""

import datetime as dt

from strata.operators import arrays, graph, jobs, scd


def test_scd2_streaks_change_and_single_row_key(spark):
    df = spark.createDataFrame(
        [("north", 11, "low"), ("north", 12, "low"), ("north", 13, "low"), ("north", 14, "high"), ("south", 14, "high")],
        "player_name string, current_season long, scoring_class string")
    out = scd.scd2_streaks(df, "player_name", "current_season", ["scoring_class"])
    got = sorted((r.player_name, r.scoring_class, r.start_date, r.end_date) for r in out.collect())
    assert got == [("north", "high", 14, 14), ("north", "low", 11, 13), ("south", "high", 14, 14)]


def test_scd2_streaks_return_to_class_and_gap(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("a", 7, "x")],
        "player_name string, current_season long, scoring_class string")
    out = scd.scd2_streaks(df, "player_name", "current_season", ["scoring_class"])
    got = sorted((r.scoring_class, r.start_date, r.end_date) for r in out.collect())
    # returning to an earlier class is a new streak; a season gap does not break one
    assert got == [("x", 1, 1), ("x", 3, 7), ("y", 2, 2)]


def test_monthly_positional_sums(spark):
    df = spark.createDataFrame([("m1", [4, 0, 5, 7]), ("m1", [6, 1]), ("m2", [])], "month_start string, hit_array array<long>")
    got = sorted(map(tuple, arrays.positional_sums(df, "hit_array", 3, ["a", "b", "c"]).collect()))
    assert got == [("m1", 10, 1, 5), ("m2", 0, 0, 0)]


def test_monthly_positional_sums_nulls_and_long_arrays(spark):
    df = spark.createDataFrame([("m", [None, 1, 3, 9]), ("m", None)], "month_start string, hit_array array<long>")
    out = arrays.positional_sums(df, "hit_array", 3, ["a", "b", "c"]).collect()[0]
    assert (out.a, out.b, out.c) == (0, 1, 3)


def test_team_vertex_dedupe(spark):
    schema = "team_id long, abbreviation string, nickname string, city string, arena string, yearfounded long"
    teams = spark.createDataFrame([(40, "KIT", "Kites", "Lund", "Hall 4", 1951), (40, "KIT", "Asters", "Lund", "Hall 4", 1951),
                                   (41, "OWL", "Owls", "Ghent", "Dome", 1988)], schema)
    rows = {r.identifier: r for r in graph.team_vertices(teams).collect()}
    assert set(rows) == {40, 41} and {r.type for r in rows.values()} == {"team"}
    assert rows[40].properties == {"abbreviation": "KIT", "nickname": "Kites", "city": "Lund", "arena": "Hall 4",
                                   "year_founded": "1951"}


def test_player_ranking_tiers_minimum_games_and_null_kills(spark):
    games = ([("anna", 31, 2)] * 5 + [("bo", 31, 9)] * 6 + [("cy", 13, 4)] * 5 + [("di", 2, 20)] * 7
             + [("ed", 40, 1)] * 4                       # too few games
             + [("flo", None, 3)] * 9)                   # kills never recorded
    df = spark.createDataFrame(games, "player_gamertag string, player_total_kills long, player_total_deaths long")
    got = {r.player_gamertag: (r.avg_kills, r.avg_deaths, r.games_played, r.kill_rank, r.skill_tier)
           for r in jobs.player_ranking(df).collect()}
    assert got == {"anna": (31.0, 2.0, 5, 1, "Elite"), "bo": (31.0, 9.0, 6, 1, "Elite"),
                   "cy": (13.0, 4.0, 5, 3, "Good"), "di": (2.0, 20.0, 7, 4, "Beginner")}


def test_user_activity_by_month(spark):
    at = lambda day, hour: dt.datetime(2022, *day, hour)
    df = spark.createDataFrame(
        [(8, at((6, 1), 0), "a.test", "/"), (8, at((6, 30), 23), "b.test", "/"), (8, at((6, 9), 5), "b.test", "/buy"),
         (8, at((6, 9), 6), "a.test", "/buy"), (8, at((7, 1), 0), "a.test", "/buy"), (None, at((6, 2), 1), "a.test", "/")],
        "user_id long, event_time timestamp_ntz, host string, url string")
    got = {(r.user_id, r.month_start.month): (r.total_events, r.unique_hosts, round(r.homepage_ratio, 6))
           for r in jobs.user_activity_monthly(df).collect()}
    assert got == {(8, 6): (4, 2, 0.5), (8, 7): (1, 1, 0.0)}
