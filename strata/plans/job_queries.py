"""Queries over the batch jobs, experiments and IP enrichment
(D33, D37-D43)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import experiment, geo, jobs
from strata.plans.oracle_views import with_views
from strata.plans.registry import query, r6
from strata.sources import adapters as A


@query("d37_match_report", oracle=with_views("match_details", "matches",
                                             "medals_matches_players", "medals", "maps") + """,
k AS (SELECT 'top_killer' AS question, player_gamertag AS answer,
             ROUND(AVG(player_total_kills), 6) AS value
      FROM match_details WHERE player_total_kills IS NOT NULL
      GROUP BY player_gamertag ORDER BY AVG(player_total_kills) DESC, player_gamertag LIMIT 1),
p AS (SELECT 'top_playlist' AS question, playlist_id AS answer,
             CAST(COUNT(DISTINCT match_id) AS DOUBLE) AS value
      FROM matches GROUP BY playlist_id ORDER BY value DESC, answer LIMIT 1),
m AS (SELECT 'top_map' AS question, mp.name AS answer,
             CAST(COUNT(DISTINCT m.match_id) AS DOUBLE) AS value
      FROM matches m JOIN maps mp ON m.mapid = mp.mapid WHERE mp.name IS NOT NULL
      GROUP BY mp.name ORDER BY value DESC, answer LIMIT 1),
s AS (SELECT 'top_medal_map' AS question, mp.name AS answer,
             CAST(SUM(x.count) AS DOUBLE) AS value
      FROM medals_matches_players x JOIN medals md ON x.medal_id = md.medal_id
      JOIN matches m ON x.match_id = m.match_id JOIN maps mp ON m.mapid = mp.mapid
      WHERE md.name = 'Killing Spree' AND mp.name IS NOT NULL
      GROUP BY mp.name ORDER BY value DESC, answer LIMIT 1)
SELECT * FROM k UNION ALL SELECT * FROM p UNION ALL SELECT * FROM m UNION ALL SELECT * FROM s
""")
def d37_match_report(t):
    """Top killer, most played playlist and map, map with most Killing Spree medals."""
    r = jobs.match_report(A.match_details(t), A.matches(t), A.medals_matches_players(t),
                          A.medals(t), A.maps(t))
    return r.select("question", "answer", r6("value").alias("value"))


@query("d38_player_ranking", headline=True, oracle=with_views("match_details") + """
SELECT player_gamertag, ROUND(AVG(player_total_kills), 6) AS avg_kills,
       ROUND(AVG(player_total_deaths), 6) AS avg_deaths, COUNT(*) AS games_played,
       CAST(RANK() OVER (ORDER BY AVG(player_total_kills) DESC) AS INTEGER) AS kill_rank,
       CASE WHEN AVG(player_total_kills) > 20 THEN 'Elite'
            WHEN AVG(player_total_kills) > 10 THEN 'Good' ELSE 'Beginner' END AS skill_tier
FROM match_details WHERE player_total_kills IS NOT NULL
GROUP BY player_gamertag HAVING COUNT(*) >= 5
""")
def d38_player_ranking(t):
    """Average kills/deaths per player, global kill rank and skill tier."""
    r = jobs.player_ranking(A.match_details(t))
    return r.select("player_gamertag", r6("avg_kills").alias("avg_kills"),
                    r6("avg_deaths").alias("avg_deaths"), "games_played", "kill_rank", "skill_tier")


@query("d39_user_activity_monthly", oracle=with_views("web_events") + """
SELECT user_id, CAST(date_trunc('month', event_time) AS DATE) AS month_start,
       COUNT(*) AS total_events, COUNT(DISTINCT host) AS unique_hosts,
       ROUND(AVG(CASE WHEN url = '/' THEN 1.0 ELSE 0.0 END), 6) AS homepage_ratio
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2
""")
def d39_user_activity_monthly(t):
    """Per user-month events, distinct hosts and homepage share."""
    r = jobs.user_activity_monthly(A.web_events(t))
    return r.select("user_id", "month_start", "total_events", "unique_hosts",
                    r6("homepage_ratio").alias("homepage_ratio"))


_UDEV_SQL = with_views("web_events", "devices") + """,
agg AS (SELECT user_id, device_id, COUNT(*) AS event_counts,
               string_agg(DISTINCT host, ',' ORDER BY host) AS hosts FROM web_events GROUP BY 1, 2),
users AS (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL)
"""


@query("d40_users_devices", oracle=_UDEV_SQL + """
SELECT u.user_id, MAX(a.event_counts) AS total_hits,
       string_agg(CAST(a.device_id AS VARCHAR), ',' ORDER BY a.device_id) AS devices
FROM users u JOIN agg a ON a.user_id = u.user_id GROUP BY u.user_id
""")
def d40_users_devices(t):
    """Per user: the largest per-device event count and the device list."""
    ev = A.web_events(t)
    agg = jobs.events_per_user_device(ev)
    users = ev.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    r = jobs.users_and_devices(agg, users)
    return r.select("user_id", "total_hits",
                    F.array_join(F.transform("devices", lambda x: x.cast("string")), ",")
                    .alias("devices"))


@query("d40_devices_users", oracle=_UDEV_SQL + """,
j AS (SELECT d.device_id, d.device_type, a.user_id, a.hosts FROM devices d JOIN agg a
      ON d.device_id = a.device_id)
SELECT j.device_id, j.device_type, j.user_id, j.hosts, c.num_users
FROM j JOIN (SELECT device_id, COUNT(DISTINCT user_id) AS num_users FROM j GROUP BY 1) c
  ON j.device_id = c.device_id
""")
def d40_devices_users(t):
    """Per device: its users as (device, user) rows and the user count."""
    agg = jobs.events_per_user_device(A.web_events(t))
    found = jobs.devices_on_events(agg, A.devices(t))
    return found.select("device_id", "device_type", "user_id", F.array_join("host_array", ",").alias("hosts"), "num_users")


EXPERIMENT = "checkout_layout"
CELLS = [("blue", 25), ("green", 25), ("red", 25), ("orange", 25)]

_ASSIGN_SQL = with_views("web_events") + """,
u AS (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL),
a AS (SELECT user_id,
             CAST(('0x' || substr(md5('checkout_layout:' || CAST(user_id AS VARCHAR)), 1, 8))
                  AS BIGINT) % 10000 AS bucket
      FROM u),
asg AS (SELECT user_id, bucket,
               CASE WHEN bucket < 2500 THEN 'blue' WHEN bucket < 5000 THEN 'green'
                    WHEN bucket < 7500 THEN 'red' ELSE 'orange' END AS cell,
               'checkout_layout' AS experiment FROM a)
"""


def _assignments(t):
    units = A.web_events(t).where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return experiment.assign_variant(units, EXPERIMENT, CELLS)


@query("d41_assign_variant", oracle=_ASSIGN_SQL + "SELECT * FROM asg")
def d41_assign_variant(t):
    """Deterministic four-cell assignment of every user."""
    return _assignments(t)


@query("d42_experiment_readout", oracle=_ASSIGN_SQL + """,
conv AS (SELECT DISTINCT user_id FROM web_events WHERE url = '/signup' AND user_id IS NOT NULL),
per AS (SELECT cell, COUNT(*) AS units, COUNT(c.user_id) AS converters,
               CAST(COUNT(c.user_id) AS DOUBLE) / COUNT(*) AS rate
        FROM asg LEFT JOIN conv c ON asg.user_id = c.user_id GROUP BY cell),
ctl AS (SELECT units AS cu, converters AS cc, rate AS cr FROM per WHERE cell = 'blue'),
x AS (SELECT per.*, ctl.*,
             (converters + cc) / CAST(units + cu AS DOUBLE) AS pooled FROM per, ctl)
SELECT cell, units, converters, ROUND(rate, 6) AS rate, ROUND(rate / cr - 1, 6) AS lift,
       ROUND(CASE WHEN sqrt(pooled * (1 - pooled) * (1.0 / units + 1.0 / cu)) > 0
                  THEN (rate - cr) / sqrt(pooled * (1 - pooled) * (1.0 / units + 1.0 / cu))
             END, 6) AS z
FROM x
""")
def d42_experiment_readout(t):
    """Per-cell signup conversion, lift and z against the control cell."""
    conv = A.web_events(t).where((F.col("url") == "/signup") & F.col("user_id").isNotNull())
    r = experiment.experiment_readout(_assignments(t), conv, control="blue")
    return r.select("cell", "units", "converters", r6("rate").alias("rate"),
                    r6("lift").alias("lift"), r6("z").alias("z"))


@query("d43_business_metrics", oracle="""
WITH o AS (SELECT o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders),
f AS (SELECT day, COUNT(*) AS new_customers FROM
        (SELECT o_custkey, MIN(day) AS day FROM o GROUP BY o_custkey) GROUP BY day),
d AS (SELECT o.day, SUM(o_totalprice) AS revenue, COUNT(*) AS num_orders,
             COUNT(DISTINCT o_custkey) AS active_customers,
             CAST(COALESCE(MAX(f.new_customers), 0) AS BIGINT) AS new_customers
      FROM o LEFT JOIN f ON o.day = f.day GROUP BY o.day)
SELECT day, ROUND(revenue, 4) AS revenue, num_orders, active_customers, new_customers,
       ROUND(revenue - LAG(revenue) OVER (ORDER BY day), 4) AS revenue_change,
       CAST(SUM(new_customers) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cumulative_customers,
       ROUND(CAST(num_orders AS DOUBLE) / active_customers, 6) AS orders_per_customer
FROM d
""")
def d43_business_metrics(t):
    """Daily revenue, orders, active/new customers, change and engagement."""
    r = jobs.business_metrics(t.orders)
    return r.select("day", F.round("revenue", 4).alias("revenue"), "num_orders",
                    "active_customers", "new_customers",
                    F.round("revenue_change", 4).alias("revenue_change"),
                    "cumulative_customers", r6("orders_per_customer").alias("orders_per_customer"))


@query("d33_geo_enrich", headline=True, oracle="""
WITH ev AS (
  SELECT CASE WHEN event_type = 'view' THEN '/' ELSE '/' || event_type END AS url,
         'h' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR)
             || '.example' AS host,
         '10.' || CAST(CAST(floor(user_id / 256) AS BIGINT) % 256 AS VARCHAR) || '.'
             || CAST(user_id % 256 AS VARCHAR) || '.'
             || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 256 AS VARCHAR) AS ip,
         ts AS event_time,
         167772160 + user_id * 256 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 256
             AS ipl
  FROM events),
r AS (SELECT 167772160 + c.c_custkey * 256 AS ip_start, 167772160 + c.c_custkey * 256 + 255 AS ip_end,
             n.n_name AS country, 'state_' || CAST(c.c_custkey % 50 AS VARCHAR) AS state,
             'city_' || CAST(c.c_custkey % 500 AS VARCHAR) AS city
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT ev.url, ev.host, ev.ip, ev.event_time, r.country, r.state, r.city,
       CASE WHEN r.country IS NULL THEN '{}'
            ELSE '{"country":"' || r.country || '","state":"' || r.state || '","city":"'
                 || r.city || '"}' END AS geodata
FROM ev LEFT JOIN r ON ev.ipl BETWEEN r.ip_start AND r.ip_end
""")
def d33_geo_enrich(t):
    """Every web event with country/state/city of its IP (range join)."""
    return geo.geo_enrich(A.web_events_ip(t), A.ip_ranges(t))
