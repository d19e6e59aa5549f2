"""Thin queries for the relational primitives of SURVEY §2 that no pattern
query already exercises on its own (joins, rollups, unnest, sorts, ...), and
the game-detail homework analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from strata.functions.columns import array_text, day_range, first_last_ratio
from strata.operators import dims, games, relational as R
from strata.plans.oracle_views import with_views
from strata.plans.registry import query, r6
from strata.plans.report import LAST_DAY_SQL, LAST_SEASON_SQL, last_day, last_season
from strata.sources import adapters as A

_DEDUP = with_views("game_details", "games") + """,
dd AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id, game_id ORDER BY team_id,
         team_abbreviation, player_name, start_position_no, pts, reb, ast) AS rn
  FROM game_details) WHERE rn = 1),
tg AS (SELECT x.team_id, x.game_id, g.game_date_est, g.season,
              (x.team_id = g.home_team_id AND g.home_team_wins)
              OR (x.team_id = g.visitor_team_id AND NOT g.home_team_wins) AS won
       FROM (SELECT DISTINCT game_id, team_id FROM dd) x JOIN games g ON x.game_id = g.game_id)
"""


@query("a07_game_grouping_sets", headline=True, oracle=_DEDUP + """
SELECT CASE WHEN GROUPING(player_id) = 0 AND GROUPING(team_id) = 0 THEN 'player_team'
            WHEN GROUPING(player_id) = 0 AND GROUPING(season) = 0 THEN 'player_season'
            ELSE 'team' END AS aggregation_level,
       player_id, team_id, season, CAST(SUM(pts) AS BIGINT) AS total_points,
       COUNT(DISTINCT CASE WHEN won THEN d.game_id END) AS games_won
FROM dd d JOIN tg USING (team_id, game_id)
GROUP BY GROUPING SETS ((player_id, team_id), (player_id, season), (team_id))
""")
def a07_game_grouping_sets(t):
    """Points per (player, team), (player, season) and wins per team."""
    return games.game_grouping_sets(A.game_details(t), A.games(t))


@query("w14_most_wins_in_90_games", headline=True, oracle=_DEDUP + """
SELECT team_id, CAST(MAX(w) AS BIGINT) AS max_wins_in_90, COUNT(*) AS games FROM (
  SELECT team_id, SUM(CAST(won AS INTEGER)) OVER (PARTITION BY team_id
         ORDER BY game_date_est, game_id ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS w
  FROM tg) GROUP BY team_id
""")
def w14_most_wins_in_90_games(t):
    """Most games a team won in any 90-game stretch."""
    return games.most_wins_in_stretch(A.game_details(t), A.games(t), 90)


@query("w15_longest_scoring_run", oracle=_DEDUP + """,
x AS (SELECT d.player_id, d.pts > 10 AS hit,
             ROW_NUMBER() OVER (PARTITION BY d.player_id ORDER BY g.game_date_est, d.game_id)
           - ROW_NUMBER() OVER (PARTITION BY d.player_id, d.pts > 10
                                ORDER BY g.game_date_est, d.game_id) AS grp
      FROM dd d JOIN games g ON d.game_id = g.game_id)
SELECT player_id, MAX(n) AS longest_run FROM (
  SELECT player_id, grp, COUNT(*) AS n FROM x WHERE hit GROUP BY player_id, grp)
GROUP BY player_id
""")
def w15_longest_scoring_run(t):
    """Most consecutive games a player scored over 10 points."""
    return games.longest_scoring_run(A.game_details(t), A.games(t), 10)


@query("a01_rollups", oracle="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 4) AS sum_qty,
       ROUND(AVG(l_extendedprice), 6) AS avg_price, MIN(l_discount) AS min_disc,
       MAX(l_tax) AS max_tax
FROM lineitem GROUP BY 1, 2
""")
def a01_rollups(t):
    """count/sum/avg/min/max by key (A1)."""
    l = t.lineitem
    return l.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("sum_qty"),
        r6(F.avg("l_extendedprice")).alias("avg_price"), F.min("l_discount").alias("min_disc"),
        F.max("l_tax").alias("max_tax"))


@query("j02_left_join_two_keys", oracle=with_views("match_details", "medals_matches_players") + """
SELECT d.match_id, d.player_gamertag, d.player_total_kills, m.medal_id, m.count
FROM match_details d LEFT JOIN medals_matches_players m
  ON d.match_id = m.match_id AND d.player_gamertag = m.player_gamertag
""")
def j02_left_join_two_keys(t):
    """Match details LEFT JOIN medals on (match, player)."""
    d = A.match_details(t).select("match_id", "player_gamertag", "player_total_kills")
    m = A.medals_matches_players(t)
    return R.join(d, m, ["match_id", "player_gamertag"], "left")


@query("j08_semi_join", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def j08_semi_join(t):
    """Orders having a returned line (IN subquery as left semi join, J8)."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    r = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(r, "o_orderkey", "left_semi")


@query("j09_anti_join", oracle="""
SELECT c.c_custkey, c.c_name FROM customer c
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON o.o_custkey = c.c_custkey
WHERE o.o_orderkey IS NULL
""")
def j09_anti_join(t):
    """Customers without an urgent order (LEFT JOIN ... IS NULL as a left
    anti join; the right side is filtered before the join, J9/J13)."""
    c = t.customer.select("c_custkey", "c_name")
    o = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_anti")


@query("a15_bitmap_aggregate", oracle=with_views("web_events") + f"""
SELECT user_id, CAST(SUM(CAST(pow(2, 31 - ({LAST_DAY_SQL} - day)) AS BIGINT)) AS BIGINT) AS bits
FROM (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events
      WHERE user_id IS NOT NULL AND event_time >= {LAST_DAY_SQL} - 31
        AND event_time < {LAST_DAY_SQL} + 1)
GROUP BY user_id
""")
def a15_bitmap_aggregate(t):
    """Bitmap of active days as an aggregate: bit_or of one bit per day."""
    e, end = A.web_events(t), last_day(t)
    begin = (dt.date.fromisoformat(end) - dt.timedelta(days=31)).isoformat()
    d = (e.where(F.col("user_id").isNotNull() & day_range("event_time", begin, 32))
          .select("user_id", F.to_date("event_time").alias("day")).distinct())
    bit = F.pow(F.lit(2.0), 31 - F.datediff(F.lit(end).cast("date"), "day")).cast("bigint")
    return d.groupBy("user_id").agg(F.bit_or(bit).alias("bits"))


@query("f16_unnest_films", oracle=with_views("actor_films") + """
SELECT actorid, year, film, votes, rating FROM actor_films
""")
def f16_unnest_films(t):
    """Film struct arrays of the yearly actor rows back to rows (F16, inline)."""
    y = dims.yearly_dimension(A.actor_films(t))
    return y.select("actorid", "year", F.inline("films")).select("actorid", "year", "film",
                                                                  "votes", "rating")


@query("f14_first_last_ratio", oracle=with_views("player_seasons") + f""",
fl AS (SELECT player_name, arg_min(pts, season) AS first_pts, arg_max(pts, season) AS last_pts
       FROM player_seasons WHERE season <= {LAST_SEASON_SQL} GROUP BY player_name)
SELECT player_name, ROUND(CASE WHEN first_pts = 0 THEN 1.0 ELSE last_pts / first_pts END, 6)
           AS improvement
FROM fl
""")
def f14_first_last_ratio(t):
    """Latest season's points over the first season's, per player."""
    from strata.plans.dim_queries import player_history
    h = player_history(t).where(F.col("current_season") == last_season(t))
    return h.select("player_name", r6(first_last_ratio("seasons", "pts")).alias("improvement"))


@query("f05_predicates", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM lineitem
WHERE l_returnflag IN ('R', 'A') AND l_shipdate >= TIMESTAMP '1996-01-01'
  AND l_shipdate < TIMESTAMP '1997-01-01'
  AND (l_linestatus LIKE 'F%' OR contains(CAST(l_quantity AS VARCHAR), '5'))
  AND NOT (l_discount = 0)
""")
def f05_predicates(t):
    """=, range, IN, LIKE, contains and AND/OR/NOT predicates (F5, F6).  The
    range and IN predicates reach the parquet scan as pushed filters."""
    l = t.lineitem
    cond = (l.l_returnflag.isin("R", "A")
            & (l.l_shipdate >= F.lit("1996-01-01").cast("timestamp_ntz"))
            & (l.l_shipdate < F.lit("1997-01-01").cast("timestamp_ntz"))
            & (l.l_linestatus.like("F%") | l.l_quantity.cast("string").contains("5"))
            & ~(l.l_discount == 0))
    return l.where(cond).select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")


@query("f12_enrich_events", oracle=with_views("web_events", "devices") + """
SELECT e.user_id, e.device_id, upper(COALESCE(d.browser_type, 'unknown')) AS browser,
       COALESCE(d.os_type, 'unknown') AS os_type, e.url,
       CAST(e.event_time AS DATE) AS event_date,
       split_part(CAST(e.event_time AS VARCHAR), ' ', 1) AS date_text
FROM web_events e JOIN devices d ON e.device_id = d.device_id
""")
def f12_enrich_events(t):
    """Typed event-device projection with upper-cased browser, event date and
    the date part of the time text (F11, F12, F20)."""
    e, d = A.web_events(t), A.devices(t)
    return e.join(d, "device_id").select(
        "user_id", "device_id", F.upper(F.coalesce("browser_type", F.lit("unknown"))).alias("browser"),
        F.coalesce("os_type", F.lit("unknown")).alias("os_type"), "url",
        F.to_date("event_time").alias("event_date"),
        F.split(F.col("event_time").cast("string"), " ").getItem(0).alias("date_text"))


@query("w08_running_total", oracle=with_views("web_events") + """,
c AS (SELECT url, CAST(event_time AS DATE) AS d, COUNT(*) AS n FROM web_events GROUP BY 1, 2)
SELECT url, d, n, CAST(SUM(n) OVER (PARTITION BY url ORDER BY d) AS BIGINT) AS running_total,
       CAST(MIN(n) OVER (PARTITION BY url) AS BIGINT) AS min_daily
FROM c
""")
def w08_running_total(t):
    """Running total with the default RANGE frame and a partition minimum."""
    e = A.web_events(t)
    c = e.groupBy("url", F.to_date("event_time").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("url").orderBy("d")
    return c.select("url", "d", "n",
                    F.sum("n").over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("running_total"),
                    F.min("n").over(Window.partitionBy("url")).alias("min_daily"))


@query("f02_distinct_rows", oracle=with_views("web_events") + """
SELECT DISTINCT url, host FROM web_events
""")
def f02_distinct_rows(t):
    """DISTINCT through a projection."""
    return R.dedupe_rows(A.web_events(t), ["url", "host"])


@query("u02_labelled_union", oracle="""
SELECT 'orders' AS source, o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'lineitem', l_linestatus, COUNT(*) FROM lineitem GROUP BY 2
""")
def u02_labelled_union(t):
    """UNION ALL of labelled summaries."""
    o = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    l = t.lineitem.groupBy(F.col("l_linestatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return R.union_all(o, l, label="source", labels=["orders", "lineitem"]).select("source", "status", "n")


@query("x08_datelist_text", oracle=with_views("web_events") + """
SELECT user_id, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates
FROM (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM web_events
      WHERE user_id IS NOT NULL) GROUP BY user_id
""")
def x08_datelist_text(t):
    """Each user's active dates as text (array_sort/collect_set, X8/X12)."""
    e = A.web_events(t).where(F.col("user_id").isNotNull())
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_set(F.to_date("event_time"))).alias("ds"))
    return g.select("user_id", array_text("ds").alias("dates"))
