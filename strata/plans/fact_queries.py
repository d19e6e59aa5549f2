"""Queries over graph tables, date lists, bitmaps and monthly arrays
(D10-D24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import arrays, datelist, graph
from strata.plans.oracle_views import with_views
from strata.plans.registry import query
from strata.plans.report import LAST_DAY_SQL, day_before, last_day
from strata.sources import adapters as A


# ------------------------------------------------------------------- graph


@query("d10_team_vertices", oracle=with_views("teams") + """,
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY abbreviation DESC,
           nickname DESC, city DESC, arena DESC, yearfounded DESC) AS rn FROM teams)
SELECT team_id AS identifier, 'team' AS type, abbreviation, nickname, city, arena,
       CAST(yearfounded AS VARCHAR) AS year_founded
FROM ranked WHERE rn = 1
""")
def d10_team_vertices(t):
    """One vertex per team with its property map (flattened for comparison)."""
    v = graph.team_vertices(A.teams(t))
    p = F.col("properties")
    return v.select("identifier", "type", *[p[k].alias(k) for k in
                    ["abbreviation", "nickname", "city", "arena", "year_founded"]])


_DEDUP_SQL = with_views("game_details") + """,
dd AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id, game_id ORDER BY team_id,
         team_abbreviation, player_name, start_position_no, pts, reb, ast) AS rn
  FROM game_details) WHERE rn = 1)
"""


@query("d11_player_game_edges", oracle=_DEDUP_SQL + """
SELECT player_id AS subject_identifier, 'player' AS subject_type,
       game_id AS object_identifier, 'game' AS object_type, 'plays_in' AS edge_type,
       CAST(start_position_no AS VARCHAR) AS start_position, CAST(pts AS VARCHAR) AS pts,
       CAST(team_id AS VARCHAR) AS team_id, team_abbreviation
FROM dd
""")
def d11_player_game_edges(t):
    """plays_in edges (deduplicated game details)."""
    e = graph.player_game_edges(A.game_details(t))
    p = F.col("properties")
    return e.select("subject_identifier", "subject_type", "object_identifier", "object_type",
                    "edge_type", *[p[k].alias(k) for k in
                                   ["start_position", "pts", "team_id", "team_abbreviation"]])


@query("d12_player_player_edges", headline=True, oracle=_DEDUP_SQL + """
SELECT a.player_id AS subject_player_id, a.player_name AS subject_player_name,
       b.player_id AS object_player_id, b.player_name AS object_player_name,
       CASE WHEN a.team_abbreviation = b.team_abbreviation THEN 'shares_team'
            ELSE 'plays_against' END AS edge_type,
       COUNT(*) AS num_games, CAST(SUM(a.pts) AS BIGINT) AS subject_points,
       CAST(SUM(b.pts) AS BIGINT) AS object_points
FROM dd a JOIN dd b ON a.game_id = b.game_id AND a.player_name <> b.player_name
WHERE a.player_id > b.player_id
GROUP BY 1, 2, 3, 4, 5
""")
def d12_player_player_edges(t):
    """shares_team / plays_against edges with games and points per pair."""
    return graph.player_player_edges(A.game_details(t))


@query("d13_graph_union", oracle=_DEDUP_SQL + """,
""" + with_views("teams", "games")[5:] + """,
tv AS (SELECT team_id FROM teams GROUP BY team_id),
pv AS (SELECT player_id FROM dd GROUP BY player_id),
pp AS (SELECT a.player_id AS s, b.player_id AS o,
              CASE WHEN a.team_abbreviation = b.team_abbreviation THEN 'shares_team'
                   ELSE 'plays_against' END AS et
       FROM dd a JOIN dd b ON a.game_id = b.game_id AND a.player_name <> b.player_name
       WHERE a.player_id > b.player_id GROUP BY a.player_id, a.player_name, b.player_id,
             b.player_name, 3),
pt AS (SELECT player_id, team_id FROM dd GROUP BY player_id, team_id),
parts AS (
  SELECT 'vertex' AS kind, 'player' AS type, COUNT(*) AS n FROM pv
  UNION ALL SELECT 'vertex', 'team', COUNT(*) FROM tv
  UNION ALL SELECT 'vertex', 'game', COUNT(*) FROM games
  UNION ALL SELECT 'edge', 'plays_in', COUNT(*) FROM dd
  UNION ALL SELECT 'edge', et, COUNT(*) FROM pp GROUP BY et
  UNION ALL SELECT 'edge', 'plays_on', COUNT(*) FROM pt)
SELECT kind, type, CAST(n AS BIGINT) AS n FROM parts
""")
def d13_graph_union(t):
    """Typed vertex and edge tables; row counts per kind and type."""
    v, e = graph.graph_union(A.game_details(t), A.teams(t), A.games(t))
    vc = v.groupBy("type").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("vertex"))
    ec = (e.groupBy(F.col("edge_type").alias("type")).agg(F.count(F.lit(1)).alias("n"))
           .withColumn("kind", F.lit("edge")))
    return vc.unionByName(ec).select("kind", "type", "n")


@query("d13_graph_vertices", oracle=_DEDUP_SQL + """,
""" + with_views("teams", "games")[5:] + """,
tr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY abbreviation DESC,
       nickname DESC, city DESC, arena DESC, yearfounded DESC) AS rn FROM teams)
SELECT CAST(player_id AS VARCHAR) AS identifier, 'player' AS type,
       'num_teams=' || CAST(COUNT(DISTINCT team_id) AS VARCHAR)
       || ';number_of_games=' || CAST(COUNT(*) AS VARCHAR)
       || ';player_name=' || MAX(player_name)
       || ';total_points=' || CAST(SUM(pts) AS VARCHAR) AS props
FROM dd GROUP BY player_id
UNION ALL
SELECT CAST(team_id AS VARCHAR), 'team',
       'abbreviation=' || abbreviation || ';arena=' || arena || ';city=' || city
       || ';nickname=' || nickname || ';year_founded=' || CAST(yearfounded AS VARCHAR)
FROM tr WHERE rn = 1
UNION ALL
SELECT CAST(game_id AS VARCHAR), 'game',
       'home_team_id=' || CAST(home_team_id AS VARCHAR)
       || ';home_team_wins=' || CASE WHEN home_team_wins THEN 'true' ELSE 'false' END
       || ';season=' || CAST(season AS VARCHAR)
       || ';visitor_team_id=' || CAST(visitor_team_id AS VARCHAR)
FROM games
""")
def d13_graph_vertices(t):
    """The typed vertex table (players, teams, games) with each property map
    as sorted key=value text."""
    v, _ = graph.graph_union(A.game_details(t), A.teams(t), A.games(t))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("properties")),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return v.select("identifier", "type", text.alias("props"))


# --------------------------------------------------------------- date lists

_ACT_SQL = with_views("web_events", "devices") + """,
ev AS (SELECT e.*, d.browser_type FROM web_events e JOIN devices d ON e.device_id = d.device_id),
act AS (SELECT DISTINCT {keys}, CAST(event_time AS DATE) AS day FROM {src}
        WHERE {notnull} AND event_time < {last} + 1),
firsts AS (SELECT {keys}, MIN(day) AS first_day FROM act GROUP BY {keys}),
spine AS (SELECT {keys}, CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP),
                 CAST({last} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM firsts),
hist AS (
  SELECT {skeys}, s.date,
         CAST(COUNT(a.day) AS BIGINT) AS num_dates_active,
         MAX(a.day) AS last_active_date,
         CAST(COALESCE(SUM(CASE WHEN s.date - a.day < 32
                                THEN CAST(pow(2, 31 - (s.date - a.day)) AS BIGINT) END), 0)
              AS BIGINT) AS datelist_int
  FROM spine s LEFT JOIN act a ON {join} AND a.day <= s.date
  GROUP BY {skeys}, s.date)
"""


def _act_sql(keys, src):
    return _ACT_SQL.format(
        last=LAST_DAY_SQL, keys=", ".join(keys), src=src,
        notnull=" AND ".join(f"{k} IS NOT NULL" for k in keys),
        skeys=", ".join(f"s.{k}" for k in keys),
        join=" AND ".join(f"s.{k} = a.{k}" for k in keys))


def _dl_out(df, keys):
    bits = datelist.datelist_int(df)
    return bits.select(*keys, "date",
                       F.size("dates_active").cast("bigint").alias("num_dates_active"),
                       F.array_max("dates_active").alias("last_active_date"),
                       "datelist_int")


def _ev_dev(t):
    return A.web_events(t).join(A.devices(t).select("device_id", "browser_type"), "device_id")


@query("d16_datelist_backfill", headline=True,
       oracle=_act_sql(["user_id"], "web_events") + "SELECT * FROM hist")
def d16_datelist_backfill(t):
    """Every daily users_cumulated snapshot of the month in one pass, with the
    32-day bitmap of each snapshot."""
    end = last_day(t)
    h = datelist.datelist_history(A.web_events(t), ["user_id"], end)
    return _dl_out(h, ["user_id"])


@query("d14_datelist_cumulate", oracle=_act_sql(["user_id", "browser_type"], "ev")
       + f"SELECT * FROM hist WHERE date = {LAST_DAY_SQL}")
def d14_datelist_cumulate(t):
    """Daily step of the user x browser date list: snapshot of the day before
    FULL JOIN today's active pairs."""
    end = last_day(t)
    ev = _ev_dev(t)
    keys = ["user_id", "browser_type"]
    prev = datelist.datelist_history(ev, keys, day_before(end))
    step = datelist.datelist_step(prev, ev, keys, end)
    return _dl_out(step, keys)


@query("d14_datelist_browser_map", oracle=_act_sql(["user_id", "browser_type"], "ev") + f"""
SELECT user_id, date,
       string_agg(browser_type || ':' || CAST(num_dates_active AS VARCHAR) || ':'
                  || CAST(last_active_date AS VARCHAR), ';' ORDER BY browser_type) AS browsers
FROM hist WHERE date = {LAST_DAY_SQL} GROUP BY user_id, date
""")
def d14_datelist_browser_map(t):
    """User x browser date lists as one map per user (browser -> dates)."""
    end = last_day(t)
    ev = _ev_dev(t)
    keys = ["user_id", "browser_type"]
    snap = datelist.datelist_history(ev, keys, end).where(F.col("date") == F.lit(end).cast("date"))
    m = datelist.datelist_map(snap, "user_id", "browser_type")
    entries = F.array_sort(F.map_entries("dates_active_by_browser_type"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit(":"), F.size(e["value"]).cast("string"), F.lit(":"),
        F.array_max(e["value"]).cast("string"))), ";")
    return m.select("user_id", "date", text.alias("browsers"))


@query("d14_datelist_user_host", oracle=_act_sql(["user_id", "host"], "web_events")
       + f"SELECT * FROM hist WHERE date = {LAST_DAY_SQL}")
def d14_datelist_user_host(t):
    """Daily step of the user x host date list (host activity cumulated)."""
    end = last_day(t)
    ev = A.web_events(t)
    keys = ["user_id", "host"]
    prev = datelist.datelist_history(ev, keys, day_before(end))
    return _dl_out(datelist.datelist_step(prev, ev, keys, end), keys)


@query("d15_host_datelist", oracle=_act_sql(["host"], "web_events")
       + f"SELECT * FROM hist WHERE date = {LAST_DAY_SQL}")
def d15_host_datelist(t):
    """Dates each host had any activity, as of the report date."""
    end = last_day(t)
    h = datelist.datelist_history(A.web_events(t), ["host"], end)
    return _dl_out(h.where(F.col("date") == F.lit(end).cast("date")), ["host"])


_BITS_SQL = _act_sql(["user_id"], "web_events") + f"""
SELECT user_id, datelist_int, lpad(bin(datelist_int), 32, '0') AS datelist_bits,
       bit_count(datelist_int) > 0 AS monthly_active,
       CAST(bit_count(datelist_int) AS BIGINT) AS l32,
       bit_count(datelist_int & 4261412864) > 0 AS weekly_active,
       CAST(bit_count(datelist_int & 4261412864) AS BIGINT) AS l7,
       bit_count(datelist_int & 33292288) > 0 AS weekly_active_previous_week
FROM hist WHERE date = {LAST_DAY_SQL}
"""


@query("d17_d18_datelist_int_activity", oracle=_BITS_SQL)
def d17_d18_datelist_int_activity(t):
    """Date list -> 32-bit bitmap -> monthly/weekly activity (snapshot day =
    most significant bit)."""
    end = last_day(t)
    h = datelist.datelist_history(A.web_events(t), ["user_id"], end)
    snap = datelist.datelist_int(h.where(F.col("date") == F.lit(end).cast("date")))
    out = datelist.activity_from_bits(snap.select(
        "user_id", "datelist_int", F.lpad(F.bin("datelist_int"), 32, "0").alias("datelist_bits")))
    return out


# ----------------------------------------------------------- monthly arrays

_MONTH_SQL = with_views("web_events") + """,
src AS (SELECT * FROM web_events WHERE {notnull}
        AND event_time >= date_trunc('month', {last}) AND event_time < {last} + 1),
daily AS (SELECT {keys}, CAST(dayofmonth(event_time) AS BIGINT) AS d, {metric} AS v
          FROM src GROUP BY {keys}, dayofmonth(event_time)),
ks AS (SELECT {keys}, MIN(d) AS first_d FROM daily GROUP BY {keys}),
grid AS (SELECT {keys}, first_d, unnest(generate_series(1, day({last}))) AS d FROM ks),
cells AS (
  SELECT {gkeys}, CAST(date_trunc('month', {last}) AS DATE) AS month_start, CAST(g.d - 1 AS BIGINT) AS pos,
         COALESCE(CAST(v AS BIGINT), {fill}) AS v, CAST(date_trunc('month', {last}) AS DATE) + CAST(g.first_d - 1 AS INTEGER) AS first_found_date
  FROM grid g LEFT JOIN daily x ON {join} AND g.d = x.d)
"""


def _month_sql(keys, metric="COUNT(*)", fill="NULL", notnull=None):
    nn = notnull or keys
    return _MONTH_SQL.format(last=LAST_DAY_SQL, keys=", ".join(keys), metric=metric, fill=fill,
                             notnull=" AND ".join(f"{k} IS NOT NULL" for k in nn),
                             gkeys=", ".join(f"g.{k}" for k in keys),
                             join=" AND ".join(f"g.{k} = x.{k}" for k in keys))


def _flat(df, keys, name, out="v", extra=("first_found_date",)):
    return df.select(*keys, "month_start", *extra,
                     F.posexplode(name).alias("pos", out)) \
             .withColumn("pos", F.col("pos").cast("bigint"))


@query("d19_monthly_hits_step", oracle=_month_sql(["user_id"])
       + "SELECT user_id, month_start, first_found_date, pos, v AS hits FROM cells")
def d19_monthly_hits_step(t):
    """NULL-padded daily hit array per user-month: the month so far, then one
    daily step for the report date (positioned by day of month)."""
    end = last_day(t)
    ev = A.web_events(t)
    prev = arrays.metric_month(ev, ["user_id"], day_before(end), None, name="hit_array")
    step = arrays.metric_step(prev, ev, ["user_id"], end, None, name="hit_array")
    return _flat(step, ["user_id"], "hit_array", "hits")


@query("d20_array_metric_step", oracle=_month_sql(["user_id"], fill="0")
       + "SELECT user_id, month_start, 'site_hits' AS metric_name, pos, v AS value FROM cells")
def d20_array_metric_step(t):
    """0-padded metric array per (user, month, metric), upserted by one step."""
    end = last_day(t)
    ev = A.web_events(t)
    prev = arrays.metric_month(ev, ["user_id"], day_before(end), 0, name="metric_array") \
        .withColumn("metric_name", F.lit("site_hits"))
    new = arrays.metric_step(prev, ev, ["user_id"], end, 0, name="metric_array") \
        .withColumn("metric_name", F.lit("site_hits"))
    table = arrays.upsert(prev, new, ["user_id", "month_start", "metric_name"])
    return _flat(table, ["user_id", "metric_name"], "metric_array", "value", extra=())


@query("d21_array_metric_daily", oracle=_month_sql(["user_id"], fill="0") + """
SELECT 'site_hits' AS metric_name, CAST(month_start + CAST(pos AS INTEGER) AS DATE) AS date,
       CAST(SUM(v) AS BIGINT) AS total
FROM cells GROUP BY 1, 2
""")
def d21_array_metric_daily(t):
    """Sum the user arrays by position: one row per (metric, date)."""
    end = last_day(t)
    m = arrays.metric_month(A.web_events(t), ["user_id"], end, 0, name="metric_array") \
        .withColumn("metric_name", F.lit("site_hits"))
    return arrays.daily_totals(m, "metric_array", group=["metric_name"])


@query("a12_positional_sums", oracle=_month_sql(["user_id"]) + """
SELECT month_start,
       CAST(SUM(CASE WHEN pos = 0 THEN COALESCE(v, 0) ELSE 0 END) AS BIGINT) AS num_hits_first_day,
       CAST(SUM(CASE WHEN pos = 1 THEN COALESCE(v, 0) ELSE 0 END) AS BIGINT) AS num_hits_second_day,
       CAST(SUM(CASE WHEN pos = 2 THEN COALESCE(v, 0) ELSE 0 END) AS BIGINT) AS num_hits_third_day
FROM cells GROUP BY month_start
""")
def a12_positional_sums(t):
    """Sum of the first three array positions per month (NULL-safe reads)."""
    end = last_day(t)
    m = arrays.metric_month(A.web_events(t), ["user_id"], end, None, name="hit_array")
    return arrays.positional_sums(m, "hit_array", 3, ["num_hits_first_day",
                                  "num_hits_second_day", "num_hits_third_day"])


_HOST_SQL = _month_sql(["host"], notnull=["host", "user_id"]) + """,
uvd AS (SELECT host, CAST(dayofmonth(event_time) AS BIGINT) AS d,
               COUNT(DISTINCT user_id) AS uv FROM src GROUP BY host, dayofmonth(event_time)),
hr AS (SELECT c.host, c.month_start, c.pos, c.v AS hits, CAST(u.uv AS BIGINT) AS uv
       FROM cells c LEFT JOIN uvd u ON c.host = u.host AND c.pos + 1 = u.d)
"""


def _host_month(t):
    end = last_day(t)
    return arrays.host_reduced_month(A.web_events(t), end)


@query("d22_host_reduced", headline=True, oracle=_HOST_SQL
       + "SELECT host, month_start, pos, hits, uv AS unique_visitors FROM hr")
def d22_host_reduced(t):
    """Per (month, host): daily hits and unique visitors arrays (flattened)."""
    end = last_day(t)
    h = arrays.host_reduced_step(
        arrays.host_reduced_month(A.web_events(t), day_before(end)), A.web_events(t), end)
    x = h.select("host", "month_start",
                 F.arrays_zip("hit_array", "unique_visitors_array").alias("z"))
    return x.select("host", "month_start", F.posexplode("z").alias("pos", "p")).select(
        "host", "month_start", F.col("pos").cast("bigint").alias("pos"),
        F.col("p.hit_array").alias("hits"),
        F.col("p.unique_visitors_array").alias("unique_visitors"))


@query("d23_host_reduced_report", oracle=_HOST_SQL + f"""
SELECT host, month_start, CAST(COUNT(*) AS BIGINT) AS days,
       MAX(CASE WHEN pos = day({LAST_DAY_SQL}) - 1 THEN hits END) AS latest_hits,
       MAX(CASE WHEN pos = day({LAST_DAY_SQL}) - 1 THEN uv END) AS latest_unique_visitors,
       CAST(SUM(COALESCE(hits, 0)) AS BIGINT) AS month_hits,
       CAST(SUM(COALESCE(uv, 0)) AS BIGINT) AS month_visitor_days,
       MAX(hits) AS peak_day_hits
FROM hr GROUP BY host, month_start
""")
def d23_host_reduced_report(t):
    """Days covered, latest values, month totals and peak day per host."""
    return arrays.host_reduced_report(_host_month(t))


# The check's input is damaged on purpose, by the host's first letter and number:
# every third host has no visitor array, every third one lacks its last day.
@query("d24_array_consistency", oracle=_HOST_SQL + """,
sizes AS (SELECT host, month_start, COUNT(*) AS days, regexp_extract(host, '[0-9]+')::INT % 3 AS damage
          FROM hr GROUP BY host, month_start)
SELECT host, month_start, CAST(days AS BIGINT) AS hit_array_length,
       CASE WHEN damage = 1 THEN CAST(days - 1 AS BIGINT) END AS unique_visitors_array_length,
       'MISMATCH' AS status
FROM sizes WHERE damage < 2
""")
def d24_array_consistency(t):
    """Host-months whose two arrays are NULL or of different length."""
    damage = F.regexp_extract("host", "[0-9]+", 0).cast("int") % 3
    visitors = F.col("unique_visitors_array")
    damaged = _host_month(t).withColumn(
        "unique_visitors_array", F.when(damage == 1, F.slice(visitors, 1, F.size(visitors) - 1)).when(damage == 2, visitors))
    return arrays.array_consistency(damaged).where("status = 'MISMATCH'").select(
        "host", "month_start", "hit_array_length", "unique_visitors_array_length", "status")


@query("d13_graph_edges", oracle=_DEDUP_SQL + """,
pairs AS (SELECT a.player_id AS s, b.player_id AS o, a.player_name AS sn, b.player_name AS obn,
                 if(a.team_abbreviation = b.team_abbreviation, 'shares_team', 'plays_against') AS kind,
                 COUNT(*) AS games, SUM(a.pts) AS sp, SUM(b.pts) AS op
          FROM dd a JOIN dd b ON a.game_id = b.game_id AND a.player_name <> b.player_name AND a.player_id > b.player_id
          GROUP BY ALL),
edges AS (
  SELECT player_id AS s, 'player' AS st, game_id AS o, 'game' AS ot, 'plays_in' AS kind,
         concat_ws(';', 'pts=' || pts, 'start_position=' || start_position_no, 'team_abbreviation=' || team_abbreviation,
                   'team_id=' || team_id) AS props FROM dd
  UNION ALL
  SELECT s, 'player', o, 'player', kind,
         concat_ws(';', 'num_games=' || games, 'object_points=' || op, 'subject_points=' || sp) FROM pairs
  UNION ALL
  SELECT player_id, 'player', team_id, 'team', 'plays_on', concat_ws(';', 'num_games=' || COUNT(*), 'pts=' || SUM(pts))
  FROM dd GROUP BY player_id, team_id)
SELECT CAST(s AS VARCHAR) AS subject_identifier, st AS subject_type, CAST(o AS VARCHAR) AS object_identifier,
       ot AS object_type, kind AS edge_type, props FROM edges
""")
def d13_graph_edges(t):
    """The typed edge table (plays_in, shares_team, plays_against, plays_on) with
    each property map as sorted key=value text."""
    _, e = graph.graph_union(A.game_details(t), A.teams(t), A.games(t))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("properties")),
                                    lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";")
    return e.select("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type",
                    text.alias("props"))
