"""Queries over dashboards, rolling windows, cubes and ranked reports
(D28, D29, D32, D34-D36)."""

from __future__ import annotations

from strata.functions.columns import RATING_TIERS
from strata.operators import olap
from strata.plans.oracle_views import with_views
from strata.plans.registry import query, r6
from strata.sources import adapters as A

REFERRER_MIN_TOTAL = 100


def _dashboard_sql() -> str:
    """One plain GROUP BY per level over the hits of each combination."""
    dims = {"os_type": "o", "device_type": "t", "browser_type": "b"}
    levels = {"os_type__device_type__browser": list(dims), **{d: [d] for d in dims}}
    parts = []
    for level, kept in levels.items():
        shown = ", ".join(f"{c} AS {d}" if d in kept else f"'(overall)' AS {d}" for d, c in dims.items())
        keys = ", ".join(dims[d] for d in kept)
        parts.append(f"SELECT '{level}' AS aggregation_level, {shown}, "
                     f"CAST(SUM(hits) AS BIGINT) AS number_of_hits FROM combos GROUP BY {keys}")
    return with_views("web_events", "devices") + """,
combos AS (SELECT ifnull(dev.os_type, 'unknown') AS o, ifnull(dev.device_type, 'unknown') AS t,
                  ifnull(dev.browser_type, 'unknown') AS b, COUNT(*) AS hits
           FROM devices dev, web_events hit WHERE hit.device_id = dev.device_id GROUP BY ALL)
""" + "\nUNION ALL ".join(parts)


@query("d28_device_dashboard", headline=True, oracle=_dashboard_sql())
def d28_device_dashboard(t):
    """Hits by (browser, device, os), browser, os and device in one pass."""
    return olap.device_dashboard(A.web_events(t), A.devices(t))


# Each day's sums come from joining the daily table with itself on row numbers
# and on months; labels come from the first rule that a referrer meets.
@query("d29_referrer_rolling", oracle=with_views("web_events", "devices") + f""",
rules(pos, needle, label) AS (VALUES (1, 'linkedin', 'Linkedin'), (2, 't.co', 'Twitter'), (3, 'google', 'Google'),
    (4, 'lnkd', 'Linkedin'), (5, 'blog.strata.example', 'On Site'), (6, 'www.strata.example', 'On Site')),
names AS (SELECT r.referrer, ifnull(arg_min(k.label, k.pos), r.referrer) AS label
          FROM (SELECT DISTINCT referrer FROM web_events WHERE referrer IS NOT NULL) r
          LEFT JOIN rules k ON contains(r.referrer, k.needle) GROUP BY r.referrer),
days AS (SELECT n.label AS referrer, hit.url, CAST(hit.event_time AS DATE) AS event_date, COUNT(*) AS hits
         FROM web_events hit JOIN names n ON n.referrer = hit.referrer
         WHERE hit.device_id IN (SELECT device_id FROM devices) GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY referrer, url ORDER BY event_date) AS i FROM days),
near AS (SELECT c.referrer, c.url, c.event_date,
                SUM(p.hits) FILTER (c.i - p.i <= 6) AS week, SUM(p.hits) FILTER (c.i - p.i >= 7) AS week_before
         FROM numbered c JOIN numbered p ON p.referrer = c.referrer AND p.url = c.url AND c.i - p.i BETWEEN 0 AND 13
         GROUP BY ALL),
months AS (SELECT referrer, url, last_day(event_date) AS month, SUM(hits) AS hits FROM days GROUP BY ALL),
totals AS (SELECT referrer, url, SUM(hits) AS hits FROM days GROUP BY ALL HAVING SUM(hits) > {REFERRER_MIN_TOTAL})
SELECT d.referrer, d.url, d.event_date, d.hits AS "count", CAST(near.week AS BIGINT) AS weekly_rolling_count,
       CAST(near.week_before AS BIGINT) AS previous_weekly_rolling_count,
       ROUND(CAST(d.hits AS DOUBLE) / months.hits, 6) AS pct_of_month,
       ROUND(CAST(d.hits AS DOUBLE) / totals.hits, 6) AS pct_of_total
FROM days d JOIN near USING (referrer, url, event_date) JOIN totals USING (referrer, url)
JOIN months ON months.referrer = d.referrer AND months.url = d.url AND months.month = last_day(d.event_date)
""")
def d29_referrer_rolling(t):
    """Daily referrer counts with weekly rolling and previous-week sums."""
    out = olap.referrer_rolling(A.web_events(t), A.devices(t), A.ON_SITE_PATTERNS,
                                min_total=REFERRER_MIN_TOTAL)
    return out.select("referrer", "url", "event_date", "count", "weekly_rolling_count",
                      "previous_weekly_rolling_count", r6("pct_of_month").alias("pct_of_month"),
                      r6("pct_of_total").alias("pct_of_total"))


# round(sum(hundredths) / (n*100), 2) half-up, in integers, from columns cents and n
_AVG2 = "CAST((cents * 200 + n * 100) // (n * 200) AS DOUBLE) / 100"
_CENTS = "SUM(CAST(round(rating * 100) AS BIGINT)) AS cents, COUNT(*) AS n"


def _cube_sql() -> str:
    """One plain GROUP BY per level, over films aggregated to the finest one;
    tiers come from a table of lower bounds."""
    tiers = ", ".join(f"({low}, '{olap.TIER_NAMES[name]}')" for low, name in RATING_TIERS)
    parts = []
    for flags, label in olap.CUBE_LABELS.items():
        dims = dict(zip(("actor", "year", "film_quality_tier"), flags))
        shown = ", ".join(f"NULL AS {d}" if rolled else d for d, rolled in dims.items())
        keys = ", ".join(d for d, rolled in dims.items() if not rolled)
        parts.append(f"""
SELECT {shown}, n AS total_films, {_AVG2} AS avg_rating, votes AS total_votes,
       CAST((votes * 2 + n) // (n * 2) AS DOUBLE) AS avg_votes_per_film,
       high AS highest_rated_film_rating, low AS lowest_rated_film_rating, '{label}' AS analysis_level
FROM (SELECT {keys + ',' if keys else ''} CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(cents) AS BIGINT) AS cents,
             CAST(SUM(votes) AS BIGINT) AS votes, MAX(high) AS high, MIN(low) AS low
      FROM fine {'GROUP BY ' + keys if keys else 'HAVING COUNT(*) > 0'})""")
    return with_views("actor_films") + f""",
tiers(bound, name) AS (VALUES {tiers}),
named AS (SELECT f.actor, f.year, f.rating, f.votes,
                 ifnull((SELECT arg_max(t.name, t.bound) FROM tiers t WHERE f.rating >= t.bound),
                        '{olap.TIER_NAMES["Poor"]}') AS film_quality_tier
          FROM actor_films f WHERE f.rating IS NOT NULL AND f.votes IS NOT NULL AND f.year IS NOT NULL),
fine AS (SELECT actor, year, film_quality_tier, {_CENTS}, SUM(votes) AS votes, MAX(rating) AS high,
                MIN(rating) AS low FROM named GROUP BY ALL)""" + "\nUNION ALL".join(parts)


@query("d32_film_tiers_cube", headline=True, oracle=_cube_sql())
def d32_film_tiers_cube(t):
    """All eight grouping sets of (actor, year, quality tier)."""
    return olap.film_tiers_cube(A.actor_films(t))


def _better(table: str, *keys: str) -> str:
    """Rank of row ``x``: one more than the rows that precede it by the keys."""
    left, right = ", ".join(f"o.{k}" for k in keys), ", ".join(f"x.{k}" for k in keys)
    return f"CAST(1 + (SELECT COUNT(*) FROM {table} o WHERE ({left}) > ({right})) AS INTEGER)"


@query("d32_best_actor_years", oracle=with_views("actor_films") + f""",
sums AS (SELECT actor, year, {_CENTS}, CAST(SUM(votes) AS BIGINT) AS total_votes FROM actor_films
         WHERE rating IS NOT NULL AND year IS NOT NULL GROUP BY ALL),
pairs AS (SELECT actor, year, n AS total_films, {_AVG2} AS avg_rating, total_votes FROM sums WHERE n >= 2)
SELECT x.*, {_better("pairs", "avg_rating", "total_films")} AS ranking
FROM (FROM pairs ORDER BY avg_rating DESC, total_films DESC, actor, year LIMIT 10) x
""")
def d32_best_actor_years(t):
    """Top-10 actor-years by average rating (at least two films)."""
    return olap.best_actor_years(A.actor_films(t))


@query("d32_most_excellent_actors", oracle=with_views("actor_films") + f""",
sums AS (SELECT actor, {_CENTS}, CAST(SUM(votes) AS BIGINT) AS total_votes_excellent
         FROM actor_films WHERE rating >= 8.0 GROUP BY actor),
stars AS (SELECT actor, n AS excellent_films, {_AVG2} AS avg_excellent_rating, total_votes_excellent
          FROM sums WHERE n > 2)
SELECT x.*, {_better("stars", "excellent_films", "avg_excellent_rating")} AS ranking
FROM (FROM stars ORDER BY excellent_films DESC, avg_excellent_rating DESC, actor LIMIT 10) x
""")
def d32_most_excellent_actors(t):
    """Top-10 actors by number of excellent films."""
    return olap.most_excellent_actors(A.actor_films(t))


@query("d32_best_years", oracle=with_views("actor_films") + f""",
sums AS (SELECT year, {_CENTS}, COUNT(*) FILTER (rating >= 8.0) AS top, COUNT(*) FILTER (rating >= 7.0) AS good
         FROM actor_films WHERE rating IS NOT NULL AND year IS NOT NULL GROUP BY year),
years AS (SELECT year, n AS total_films, top AS excellent_films, good AS good_or_better_films,
                 {_AVG2} AS avg_rating, CAST((top * 20000 + n) // (n * 2) AS DOUBLE) / 100 AS pct_excellent
          FROM sums WHERE n >= 10)
SELECT x.*, {_better("years", "excellent_films")} AS rank_by_excellent_count,
       {_better("years", "pct_excellent")} AS rank_by_excellent_percentage
FROM (FROM years ORDER BY excellent_films DESC, year LIMIT 15) x
""")
def d32_best_years(t):
    """Years with the most excellent films (at least ten films)."""
    return olap.best_years(A.actor_films(t))


_SEQ_SQL = with_views("actor_films") + """,
fo AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY actorid ORDER BY year, votes DESC, film) AS seq,
              CASE WHEN rating >= 7.0 THEN 1 ELSE 0 END AS hq,
              CAST(round(rating * 100) AS BIGINT) AS rc
       FROM actor_films WHERE rating IS NOT NULL AND year IS NOT NULL)
"""


# A stretch's sums are differences of two running sums, five films apart.
@query("d34_best_stretch", oracle=_SEQ_SQL + f""",
upto AS (SELECT a.actorid, a.actor, a.seq, SUM(b.hq) AS hits, SUM(b.rc) AS cents
         FROM fo a JOIN fo b ON b.actorid = a.actorid AND b.seq <= a.seq GROUP BY ALL),
stretches AS (SELECT z.actorid, z.actor, z.seq, CAST(z.hits - ifnull(p.hits, 0) AS BIGINT) AS hits,
                     CAST(((z.cents - ifnull(p.cents, 0)) * 2 + 5) // 10 AS DOUBLE) / 100 AS avg_rating
              FROM upto z LEFT JOIN upto p ON p.actorid = z.actorid AND p.seq = z.seq - 5 WHERE z.seq >= 5),
tops AS (SELECT actorid, max((hits, avg_rating)) AS most FROM stretches GROUP BY actorid),
best AS (SELECT DISTINCT s.actorid, s.actor, s.hits, s.avg_rating FROM stretches s JOIN tops t
         ON t.actorid = s.actorid AND t.most = (s.hits, s.avg_rating) WHERE s.hits >= 3)
SELECT x.actor, x.hits AS max_quality_films_in_stretch, x.avg_rating AS avg_rating_best_stretch,
       {_better("best", "hits", "avg_rating")} AS overall_rank
FROM (FROM best ORDER BY hits DESC, avg_rating DESC, actor LIMIT 20) x
""")
def d34_best_stretch(t):
    """Most high-rated films in any 5-film stretch, top 20 actors."""
    return olap.best_stretch(A.actor_films(t))


# A run begins at a good film without a good one before it and ends at the first
# good film from there on without a good one after it.
@query("d35_longest_streaks", headline=True, oracle=_SEQ_SQL + f""",
good AS (SELECT actorid, seq FROM fo WHERE hq = 1),
begins AS (FROM good g WHERE (g.actorid, g.seq - 1) NOT IN (FROM good)),
ends AS (FROM good g WHERE (g.actorid, g.seq + 1) NOT IN (FROM good)),
runs AS (SELECT b.actorid, b.seq AS first, MIN(e.seq) AS last
         FROM begins b JOIN ends e ON e.actorid = b.actorid AND e.seq >= b.seq GROUP BY ALL),
longest AS (SELECT actorid, max((last - first + 1, -first)) AS best FROM runs WHERE last > first GROUP BY actorid),
streaks AS (SELECT MAX(f.actor) AS actor, COUNT(*) AS n, SUM(f.rc) AS cents, MIN(f.year) AS since, MAX(f.year) AS until,
                   string_agg(f.film, ' | ' ORDER BY f.seq) AS films
            FROM longest l JOIN fo f ON f.actorid = l.actorid AND f.seq + l.best[2] BETWEEN 0 AND l.best[1] - 1 GROUP BY l.actorid),
rated AS (SELECT *, {_AVG2} AS mean FROM streaks)
SELECT x.actor, x.n AS consecutive_high_quality_films, x.since AS best_streak_start_year,
       x.until AS best_streak_end_year, x.mean AS best_streak_avg_rating, x.films AS best_streak_films,
       {_better("rated", "n", "mean")} AS streak_rank
FROM (FROM rated ORDER BY n DESC, mean DESC, actor LIMIT 15) x
""")
def d35_longest_streaks(t):
    """Longest run of consecutive films rated 7+, top 15 actors."""
    return olap.longest_streaks(A.actor_films(t))


# Years are joined with the years up to them: career numbers by counting, changes
# from the year one number below, rolling means from the last three numbers;
# percentiles from how many rows of the year have a smaller value.
@query("d36_yearly_trends", headline=True, oracle=with_views("actor_films") + """,
ys AS (SELECT actorid, MAX(actor) AS actor, year, COUNT(*) AS n, CAST(SUM(CAST(round(rating * 100) AS BIGINT)) AS BIGINT) AS s
       FROM actor_films WHERE rating IS NOT NULL AND year IS NOT NULL GROUP BY actorid, year),
career AS (SELECT a.actorid, a.actor, a.year, a.n, a.s, (a.s * 2 + a.n) // (a.n * 2) AS cents, COUNT(*) AS k
           FROM ys a JOIN ys b ON b.actorid = a.actorid AND b.year <= a.year GROUP BY ALL),
last3 AS (SELECT a.actorid, a.k, CAST(product(b.n) AS HUGEINT) AS p, COUNT(*) AS years, SUM(b.n) AS films
          FROM career a JOIN career b ON b.actorid = a.actorid AND b.k BETWEEN a.k - 2 AND a.k GROUP BY ALL),
means AS (SELECT l.actorid, l.k, l.p * l.years AS d, SUM(b.s * (l.p // b.n)) AS total,
                 CAST((l.films * 20 + l.years) // (l.years * 2) AS DOUBLE) / 10 AS films
          FROM last3 l JOIN career b ON b.actorid = l.actorid AND b.k BETWEEN l.k - 2 AND l.k GROUP BY ALL),
quality(low, label) AS (VALUES (50, '↗ Much Better'), (1, '↗ Better'), (-50, '→ Similar'), (-1000000, '↘ Worse')),
c AS (SELECT a.*, a.n - b.n AS more, a.cents - b.cents AS better
      FROM career a JOIN career b ON b.actorid = a.actorid AND b.k = a.k - 1),
by_cents AS (SELECT year, cents, COUNT(*) AS m FROM c GROUP BY ALL), by_n AS (SELECT year, n, COUNT(*) AS m FROM c GROUP BY ALL),
others AS (SELECT year, COUNT(*) - 1 AS others FROM c GROUP BY year),
placed AS (SELECT c.*, o.others, (SELECT ifnull(SUM(h.m), 0) FROM by_cents h WHERE h.year = c.year AND h.cents < c.cents) AS worse,
                  (SELECT ifnull(SUM(h.m), 0) FROM by_n h WHERE h.year = c.year AND h.n < c.n) AS lazier
           FROM c JOIN others o USING (year))
SELECT p.actor, p.year, p.n AS films_that_year, CAST(p.cents AS DOUBLE) / 100 AS avg_rating_that_year,
       p.k AS career_year_number,
       ['↘ Less Active', '→ Same Activity', '↗ More Active'][CAST(sign(p.more) AS INTEGER) + 2] AS activity_trend,
       q.label AS quality_trend, CAST((m.total * 2 + m.d) // (m.d * 2) AS DOUBLE) / 100 AS rolling_3yr_avg_rating,
       m.films AS rolling_3yr_avg_films_per_year,
       CAST((p.worse * 2000 + p.others) // (p.others * 2) AS DOUBLE) / 10 AS rating_percentile,
       CAST((p.lazier * 2000 + p.others) // (p.others * 2) AS DOUBLE) / 10 AS productivity_percentile
FROM placed p JOIN means m ON m.actorid = p.actorid AND m.k = p.k ASOF JOIN quality q ON p.better >= q.low
WHERE p.others > 0 AND (p.worse * 10 >= 8 * p.others OR p.lazier * 10 >= 8 * p.others)
ORDER BY p.year DESC, p.cents DESC, p.actor LIMIT 25
""")
def d36_yearly_trends(t):
    """Year-over-year actor trends, top 20 % by rating or productivity."""
    return olap.yearly_trends(A.actor_films(t))
