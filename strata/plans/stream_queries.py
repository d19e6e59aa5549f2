"""The stream operators (T2-T4, T9) run on the bounded copy of the web event
stream.  The same functions run under ``readStream`` (see tests); a static
DataFrame makes them comparable with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans.registry import query
from strata.sources import adapters as A
from strata.streaming import sources as S, windows as W

NAMED_HOSTS = ("h0.example", "h1.example", "h2.example")
HOST_PATTERN = "%.example"     # matches all five hosts

_EV_SQL = """
WITH ev AS (
  SELECT CASE WHEN event_type = 'view' THEN '/' ELSE '/' || event_type END AS url,
         CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 7
              WHEN 0 THEN 'https://www.google.com/search' WHEN 1 THEN 'https://t.co/x1'
              WHEN 2 THEN 'https://www.linkedin.com/feed' WHEN 3 THEN 'https://lnkd.in/post'
              WHEN 4 THEN 'https://blog.strata.example/home'
              WHEN 6 THEN 'https://news.example.org/' ELSE NULL END AS referrer,
         'h' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR)
             || '.example' AS host,
         '10.' || CAST(CAST(floor(user_id / 256) AS BIGINT) % 256 AS VARCHAR) || '.'
             || CAST(user_id % 256 AS VARCHAR) || '.'
             || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 256 AS VARCHAR) AS ip,
         date_trunc('millisecond', ts) AS event_time
  FROM events)"""

_SESS_SQL = _EV_SQL + """,
s AS (SELECT ip, host, event_time AS t,
             CASE WHEN LAG(event_time) OVER w IS NULL
                    OR event_time - LAG(event_time) OVER w > INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS nw
      FROM ev WINDOW w AS (PARTITION BY ip, host ORDER BY event_time)),
g AS (SELECT *, SUM(nw) OVER (PARTITION BY ip, host ORDER BY t
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s),
sess AS (SELECT MIN(t) AS session_start, MAX(t) + INTERVAL 5 MINUTE AS session_end, ip, host,
                COUNT(*) AS num_events FROM g GROUP BY ip, host, sid)
"""


def _stream(t):
    """Parsed web stream (text event time -> timestamp, 15 s watermark)."""
    return S.with_event_time(A.web_stream_events(t), "event_time")


def _ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


@query("t02_tumbling_hits_host", oracle=_EV_SQL + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host,
       COUNT(host) AS num_hits FROM ev GROUP BY 1, 2
""")
def t02_tumbling_hits_host(t):
    """Hits per host in 5-minute tumbling windows."""
    r = W.tumbling_hits(_stream(t), "5 minutes", ["host"])
    return r.select(_ntz("event_hour"), "host", "num_hits")


@query("t03_tumbling_hits_referrer", oracle=_EV_SQL + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, referrer,
       COUNT(host) AS num_hits FROM ev GROUP BY 1, 2, 3
""")
def t03_tumbling_hits_referrer(t):
    """Hits per host and referrer in 5-minute tumbling windows."""
    r = W.tumbling_hits(_stream(t), "5 minutes", ["host", "referrer"])
    return r.select(_ntz("event_hour"), "host", "referrer", "num_hits")


@query("t04_sessionize", headline=True, oracle=_SESS_SQL + "SELECT * FROM sess")
def t04_sessionize(t):
    """Sessions per (ip, host) with a 5-minute gap."""
    r = W.sessionize(_stream(t), "5 minutes", ["ip", "host"])
    return r.select(_ntz("session_start"), _ntz("session_end"), "ip", "host", "num_events")


@query("t09_session_summary", oracle=_SESS_SQL + f""",
per AS (SELECT host, COUNT(*) AS n, ROUND(AVG(num_events), 2) AS mean FROM sess GROUP BY host),
chosen AS (SELECT COUNT(*) AS n, SUM(num_events) AS events, ROUND(AVG(num_events), 2) AS mean
           FROM sess WHERE ends_with(host, '.example'))
SELECT report, key, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'total_sessions' AS report, NULL::VARCHAR AS key, (SELECT COUNT(*) FROM sess)::DOUBLE AS value
  UNION ALL SELECT 'pattern_sessions', NULL, n FROM chosen
  UNION ALL SELECT 'pattern_events', NULL, events FROM chosen
  UNION ALL SELECT 'pattern_avg_events', NULL, mean FROM chosen
  UNION ALL SELECT 'first_session_start', NULL, epoch_us(MIN(session_start)) FROM sess
  UNION ALL SELECT 'last_session_start', NULL, epoch_us(MAX(session_start)) FROM sess
  UNION ALL SELECT 'sessions_per_host', host, n FROM per
  UNION ALL SELECT 'named_host_sessions', host, n FROM per WHERE host IN {NAMED_HOSTS}
  UNION ALL SELECT 'named_host_avg_events', host, mean FROM per WHERE host IN {NAMED_HOSTS}
  UNION ALL SELECT 'busy_host_sessions', host, n FROM per WHERE n > 1
  UNION ALL SELECT 'busy_host_avg_events', host, mean FROM per WHERE n > 1)
""")
def t09_session_summary(t):
    """The session reports as (report, key, value) rows."""
    sess = W.sessionize(_stream(t), "5 minutes", ["ip", "host"])
    return W.session_summary(sess, HOST_PATTERN, NAMED_HOSTS)
