"""The domain tables of ``strata.sources.adapters`` written as SQL CTEs.

The oracle queries run in DuckDB over the raw driver tables; each one starts
with ``WITH`` plus the views it needs from here.  Keep these in step with the
Spark adapters.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "web_events": """
web_events AS (
  SELECT CASE WHEN event_type = 'view' THEN '/' ELSE '/' || event_type END AS url,
         CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 7
              WHEN 0 THEN 'https://www.google.com/search'
              WHEN 1 THEN 'https://t.co/x1'
              WHEN 2 THEN 'https://www.linkedin.com/feed'
              WHEN 3 THEN 'https://lnkd.in/post'
              WHEN 4 THEN 'https://blog.strata.example/home'
              WHEN 6 THEN 'https://news.example.org/'
              ELSE NULL END AS referrer,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 = 0
              THEN NULL ELSE user_id END AS user_id,
         user_id AS device_id,
         'h' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR)
             || '.example' AS host,
         ts AS event_time,
         event_type,
         value
  FROM events)""",
    "devices": """
devices AS (
  SELECT c.c_custkey AS device_id, c.c_mktsegment AS browser_type,
         CAST(c.c_nationkey AS BIGINT) AS browser_version_major,
         n.n_name AS os_type, r.r_name AS device_type
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "player_seasons": """
player_seasons AS (
  SELECT 'player_' || CAST(o_custkey AS VARCHAR) AS player_name,
         CAST(5 + o_custkey % 3 AS VARCHAR) || '-' || CAST(o_custkey % 12 AS VARCHAR) AS height,
         150 + o_custkey % 100 AS weight,
         'college_' || CAST(o_custkey % 40 AS VARCHAR) AS college,
         'country_' || CAST(o_custkey % 12 AS VARCHAR) AS country,
         CAST(1990 + o_custkey % 15 AS VARCHAR) AS draft_year,
         CAST(1 + o_custkey % 2 AS VARCHAR) AS draft_round,
         CAST(1 + o_custkey % 60 AS VARCHAR) AS draft_number,
         season, gp, pts, reb, ast
  FROM (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS season,
               COUNT(*) AS gp,
               CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*)
                   / 1500000.0 AS pts,
               MIN(o_totalprice) / 20000.0 AS reb,
               MAX(o_totalprice) / 40000.0 AS ast
        FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) AS BIGINT)))""",
    "actor_films": """
actor_films AS (
  SELECT 'actor_' || CAST(o.o_custkey AS VARCHAR) AS actor,
         o.o_custkey AS actorid,
         'film_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_partkey AS VARCHAR)
             || '_' || CAST(l.l_suppkey AS VARCHAR) AS film,
         'film_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_partkey AS VARCHAR)
             || '_' || CAST(l.l_suppkey AS VARCHAR) AS filmid,
         CAST(year(o.o_orderdate) AS BIGINT) AS year,
         CAST(l.l_quantity AS BIGINT) AS votes,
         CAST(floor(l.l_extendedprice % 1000) AS DOUBLE) / 100.0 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "game_details": """
game_details AS (
  WITH base AS (
    SELECT l_orderkey AS game_id, l_suppkey AS team_id,
           'T' || CAST(l_suppkey AS VARCHAR) AS team_abbreviation,
           l_partkey AS player_id,
           'player_' || CAST(l_partkey AS VARCHAR) AS player_name,
           CAST(l_linenumber AS BIGINT) AS start_position_no,
           CAST(l_quantity AS BIGINT) AS pts,
           CAST(l_linenumber * 2 AS BIGINT) AS reb,
           CAST(floor(l_discount * 100) AS BIGINT) AS ast
    FROM lineitem)
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE start_position_no = 1)""",
    "games": """
games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
         CAST(year(o_orderdate) AS BIGINT) AS season,
         g.home_team_id, g.visitor_team_id, (o_orderkey % 3 <> 0) AS home_team_wins
  FROM orders JOIN (SELECT l_orderkey, MIN(l_suppkey) AS home_team_id,
                           MAX(l_suppkey) AS visitor_team_id
                    FROM lineitem GROUP BY l_orderkey) g ON o_orderkey = g.l_orderkey)""",
    "teams": """
teams AS (
  WITH base AS (
    SELECT s.s_suppkey AS team_id, 'T' || CAST(s.s_suppkey AS VARCHAR) AS abbreviation,
           s.s_name AS nickname, n.n_name AS city,
           'arena_' || CAST(s.s_nationkey AS VARCHAR) AS arena,
           1900 + s.s_suppkey % 100 AS yearfounded
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
  SELECT * FROM base
  UNION ALL
  SELECT team_id, abbreviation, 'Alt ' || nickname, city, arena, yearfounded
  FROM base WHERE team_id % 10 = 0)""",
    "match_details": """
match_details AS (
  SELECT l_orderkey AS match_id,
         'gamer_' || CAST(l_partkey % 300 AS VARCHAR) AS player_gamertag,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END
             AS player_total_kills,
         CAST(l_linenumber * 3 + l_partkey % 5 AS BIGINT) AS player_total_deaths
  FROM lineitem)""",
    "matches": """
matches AS (
  SELECT o_orderkey AS match_id, 'map_' || CAST(o_custkey % 25 AS VARCHAR) AS mapid,
         o_orderpriority AS playlist_id, CAST(o_orderdate AS DATE) AS completion_date
  FROM orders)""",
    "medals_matches_players": """
medals_matches_players AS (
  SELECT l_orderkey AS match_id,
         'gamer_' || CAST(l_partkey % 300 AS VARCHAR) AS player_gamertag,
         l_suppkey % 10 AS medal_id, CAST(l_linenumber AS BIGINT) AS count
  FROM lineitem)""",
    "medals": """
medals AS (
  SELECT DISTINCT p_partkey % 10 AS medal_id,
         (['Killing Spree', 'Double Kill', 'Triple Kill', 'Headshot',
           'Killing Spree Extended', 'Sniper Kill', 'First Strike',
           'Perfection', 'Overkill', 'Distraction'])[CAST(p_partkey % 10 AS INTEGER) + 1]
             AS name
  FROM part)""",
    "maps": """
maps AS (
  SELECT 'map_' || CAST(n_nationkey AS VARCHAR) AS mapid, n_name AS name FROM nation)""",
}


def with_views(*names: str) -> str:
    """``WITH v1 AS (...), v2 AS (...)`` -- callers append further CTEs with
    a leading comma, or the final SELECT."""
    return "WITH " + ",".join(VIEWS[n] for n in names)
