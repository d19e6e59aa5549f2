"""Queries over the growth, retention, funnel and state-change operators."""

from __future__ import annotations

from strata.operators import growth
from strata.plans.oracle_views import with_views
from strata.plans.registry import query, r6
from strata.plans.report import LAST_DAY_SQL, last_day
from strata.sources import adapters as A

TARGET_URL = "/signup"


_LATER = """SELECT 1 FROM visits later WHERE later.user_id = u.user_id AND later.day = u.day
                    AND later.event_time > u.event_time"""


# A unit is a user's visit of a page that some visit of the same day follows.
@query("d27_funnel", headline=True, oracle=with_views("web_events") + f""",
visits AS (SELECT user_id, url, event_time, CAST(event_time AS DATE) AS day
           FROM web_events WHERE user_id IS NOT NULL GROUP BY ALL),
units AS (SELECT u.url, EXISTS ({_LATER} AND later.url = '{TARGET_URL}') AS hit
          FROM visits u WHERE EXISTS ({_LATER}))
SELECT url, COUNT(*) AS num_units, ROUND(AVG(CAST(hit AS DOUBLE)), 6) AS conversion_rate
FROM units GROUP BY url HAVING bool_or(hit) AND COUNT(*) > 100
""")
def d27_funnel(t):
    """Page -> signup funnel over the whole event table."""
    out = growth.funnel(A.web_events(t), TARGET_URL, min_rows=100)
    return out.select("url", "num_units", r6("conversion_rate").alias("conversion_rate"))


# A user's state on a day follows from whether the user is active that day and
# from the days since the activity before it.
_GA_SQL = with_views("web_events") + f""",
act AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id ORDER BY day) AS nth
        FROM (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM web_events WHERE user_id IS NOT NULL)),
daily(active, low, high, state) AS (VALUES
  (true, 1, 1, 'Retained'), (true, 2, 100000, 'Resurrected'), (false, 1, 1, 'Churned'), (false, 2, 100000, 'Stale')),
weekly(active, low, high, state) AS (VALUES
  (true, 1, 7, 'Retained'), (true, 8, 100000, 'Resurrected'),
  (false, 1, 7, 'Retained'), (false, 8, 8, 'Churned'), (false, 9, 100000, 'Stale')),
calendar AS (SELECT unnest(range((SELECT MIN(day) FROM act), {LAST_DAY_SQL} + 1, INTERVAL 1 DAY))::DATE AS date),
spine AS (SELECT a.user_id, a.day AS first_active_date, c.date FROM act a JOIN calendar c ON c.date >= a.day WHERE a.nth = 1),
upto AS (SELECT s.*, l.day AS last_active_date, l.nth, l.day = s.date AS active
         FROM spine s ASOF JOIN act l ON l.user_id = s.user_id AND l.day <= s.date),
ga AS (SELECT u.user_id, u.first_active_date, u.last_active_date, ifnull(d.state, 'New') AS daily_active_state,
              ifnull(w.state, 'New') AS weekly_active_state, u.nth AS num_dates_active, u.date
       FROM upto u ASOF LEFT JOIN act p ON p.user_id = u.user_id AND p.day < u.date
       LEFT JOIN daily d ON d.active = u.active AND u.date - p.day BETWEEN d.low AND d.high
       LEFT JOIN weekly w ON w.active = u.active AND u.date - p.day BETWEEN w.low AND w.high)
"""


@query("d25_growth_accounting", headline=True, oracle=_GA_SQL + "SELECT * FROM ga")
def d25_growth_accounting(t):
    """Daily/weekly growth states for every user and day up to the report date."""
    return growth.growth_accounting_history(A.web_events(t), last_day(t))


@query("d26_retention_curve", oracle=_GA_SQL + f""",
debut AS (SELECT user_id, day FROM act WHERE nth = 1),
later AS (SELECT a.day - d.day AS since, COUNT(*) AS users FROM act a JOIN debut d USING (user_id) GROUP BY 1),
ages AS (SELECT unnest(range({LAST_DAY_SQL} - day + 1)) AS since, COUNT(*) AS users FROM debut GROUP BY 1)
SELECT CAST(a.since AS BIGINT) AS days_since_first_active, ROUND(ifnull(l.users, 0) / a.users, 6) AS pct_active,
       a.users AS num_users
FROM ages a LEFT JOIN later l ON l.since = a.since
""")
def d26_retention_curve(t):
    """J-curve: share of users active N days after their first activity."""
    ga = growth.growth_accounting_history(A.web_events(t), last_day(t))
    out = growth.retention_curve(ga)
    return out.select("days_since_first_active", r6("pct_active").alias("pct_active"), "num_users")
