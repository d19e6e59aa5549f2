"""Game grouping sets: rows with odd keys against plain Python, and parts that
follow the rows."""

import re
from collections import defaultdict

from strata.operators import games, graph, relational as R
from tests.test_plans import _plan

DETAILS = ("game_id long, team_id long, team_abbreviation string, player_id long, player_name string, "
           "start_position_no long, pts long, reb long, ast long")
GAMES = "game_id long, game_date_est date, season long, home_team_id long, visitor_team_id long, home_team_wins boolean"


def _rows():
    out = []
    for g in range(60):
        for p in range(12):
            out.append((g, 1 + p % 2 + g % 3, "T", p * 7 % 30, f"n{p}", p, g + p, 1, 1))
    out += [out[i] for i in range(0, len(out), 5)]                     # copies
    out += [(g, 9, "Z", p, "z", 1, 500, 1, 1) for g in range(5) for p in (0, 7)]  # a later team loses
    out += [(3, 2, "B", 100, "b", 2, 70, 1, 1), (3, 2, "A", 100, "b", 9, 8, 1, 1)]  # abbreviation before points
    out += [(None, 1, "T", 4, "x", 1, 5, 1, 1), (7, None, "T", 101, "x", 1, 5, 1, 1), (8, 2, "T", None, "x", 1, 6, 1, 1),
            (99, 1, "T", 4, "no game", 1, 5, 1, 1)]
    return out


def _games():
    return [(g, None, 2000 + g % 4, 1 + g % 3, 2 + g % 3, g % 2 == 0) for g in range(60)]


def _expected():
    low = lambda v: (v is not None, v if v is not None else 0)
    one = {}
    for r in _rows():
        order = tuple(low(v) for v in (r[1], r[2], r[4], *r[5:]))
        if (r[3], r[0]) not in one or order < one[r[3], r[0]][0]:
            one[r[3], r[0]] = (order, r)
    by_game, pts, won = {g[0]: g for g in _games()}, defaultdict(int), defaultdict(set)
    for _, r in one.values():
        if r[0] not in by_game or r[1] is None:
            continue
        _, _, season, home, visitor, home_wins = by_game[r[0]]
        team, player = r[1], r[3]
        for key in (("player_team", player, team, None), ("player_season", player, None, season), ("team", None, team, None)):
            pts[key] += r[6]
            won[key] |= {r[0]} if (team == home and home_wins) or (team == visitor and not home_wins) else set()
    return sorted((*map(str, k), pts[k], len(won[k])) for k in pts)


def _frames(spark):
    return spark.createDataFrame(_rows(), DETAILS), spark.createDataFrame(_games(), GAMES)


def test_grouping_sets_of_odd_rows_equal_plain_python(spark):
    got = games.game_grouping_sets(*_frames(spark)).collect()
    assert sorted((*map(str, r[:4]), *r[4:]) for r in got) == _expected()


def test_details_are_not_sorted_before_they_are_dealt_out(spark):
    plan = _plan(graph.dedupe_details(_frames(spark)[0]))
    assert plan.index("SortAggregate") < plan.index("Exchange") and "Sort" not in plan[plan.index("Exchange"):]


def test_parts_follow_the_rows_of_the_details(spark, monkeypatch):
    for module in (games, graph):
        monkeypatch.setattr(module, "parts_for", lambda df: R.parts_for(df, 20), raising=False)
    details, g = _frames(spark)
    out = games.game_grouping_sets(details, g)
    dealt = dict(re.findall(r"Exchange hashpartitioning\(([^()]*), (\d+)\), REPARTITION_BY_NUM", _plan(out)))
    n = str(-(-len(_rows()) // 20))
    keys = {re.sub(r"#\d+L?", "", k) for k, parts in dealt.items() if parts == n}
    assert {"player_id, game_id", "game_id", "player_id, team_id, season"} <= keys
    assert sorted((*map(str, r[:4]), *r[4:]) for r in out.collect()) == _expected()


def test_parts_for_counts_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert [R.parts_for(spark.range(n), 10) for n in (0, 1, 10 * least, 10 * least + 1)] == [least, least, least, least + 1]
