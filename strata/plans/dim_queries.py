"""Queries over cumulative dimensions and SCD2."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import dims, growth, olap, scd
from strata.plans.oracle_views import with_views
from strata.plans.registry import query
from strata.plans.report import LAST_SEASON_SQL, last_season
from strata.sources import adapters as A

STATIC = ["height", "college", "country", "draft_year", "draft_round", "draft_number"]
STATS = ["gp", "pts", "reb", "ast"]


def player_history(t, end=None):
    end = last_season(t) if end is None else end
    ps = A.player_seasons(t).where(F.col("season") <= end)
    return dims.cumulative_history(ps, "player_name", "season", end, STATS, STATIC)


def _player_out(df):
    return df.select("player_name", *STATIC,
                     F.size("seasons").cast("bigint").alias("num_seasons"),
                     F.aggregate("seasons", F.lit(0).cast("bigint"), lambda a, x: a + x["gp"])
                     .alias("total_gp"),
                     "scoring_class", "years_since_last_active", "is_active", "current_season")


_PLAYERS_SQL = with_views("player_seasons") + """,
firsts AS (SELECT player_name, MIN(season) AS first_season, MAX(height) AS height,
                  MAX(college) AS college, MAX(country) AS country, MAX(draft_year) AS draft_year,
                  MAX(draft_round) AS draft_round, MAX(draft_number) AS draft_number
           FROM player_seasons WHERE season <= {end} GROUP BY player_name),
spine AS (SELECT *, unnest(generate_series(first_season, {end})) AS season FROM firsts),
x AS (SELECT s.*, p.season AS p_season, p.gp
      FROM spine s LEFT JOIN player_seasons p
        ON s.player_name = p.player_name AND s.season = p.season),
r AS (SELECT *, COUNT(p_season) OVER w AS num_seasons, SUM(gp) OVER w AS total_gp,
             MAX(p_season) OVER w AS last_season
      FROM x WINDOW w AS (PARTITION BY player_name ORDER BY season
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
players AS (
  SELECT r.player_name, r.height, r.college, r.country, r.draft_year, r.draft_round,
         r.draft_number, CAST(r.num_seasons AS BIGINT) AS num_seasons,
         CAST(r.total_gp AS BIGINT) AS total_gp,
         CASE WHEN p.pts > 20 THEN 'star' WHEN p.pts > 15 THEN 'good'
              WHEN p.pts > 10 THEN 'average' ELSE 'bad' END AS scoring_class,
         CAST(r.season - r.last_season AS BIGINT) AS years_since_last_active,
         r.last_season = r.season AS is_active,
         CAST(r.season AS BIGINT) AS current_season
  FROM r JOIN player_seasons p ON p.player_name = r.player_name AND p.season = r.last_season)
"""


@query("d02_backfill_dimension", oracle=_PLAYERS_SQL.format(end=LAST_SEASON_SQL) + "SELECT * FROM players")
def d02_backfill_dimension(t):
    """Players dimension for every season at once (running season array)."""
    return _player_out(player_history(t))


@query("d01_cumulate_dimension", oracle=_PLAYERS_SQL.format(end=LAST_SEASON_SQL)
       + f"SELECT * FROM players WHERE current_season = {LAST_SEASON_SQL}")
def d01_cumulate_dimension(t):
    """One daily step: last season's snapshot FULL JOIN this season's rows."""
    end = last_season(t)
    prev = player_history(t, end - 1)
    cur = A.player_seasons(t)
    step = dims.cumulate_step(prev, cur, "player_name", "season", end, STATS, STATIC)
    return _player_out(step)


def _streaks_sql(*cols: str) -> str:
    """Seasons without an equal neighbour before them begin a streak, those without
    one after them end it; a streak ends at the first end from its begin on."""
    equal = " AND ".join(f"q.{c} = p.{c}" for c in cols)
    side = lambda step: (f"SELECT player_name, current_season, {', '.join(cols)} FROM players p WHERE NOT EXISTS "  # noqa: E731
                         f"(FROM players q WHERE q.player_name = p.player_name AND q.current_season = p.current_season {step} AND {equal})")
    return _PLAYERS_SQL.format(end=LAST_SEASON_SQL) + f""",
begins AS ({side("- 1")}), ends AS ({side("+ 1")}),
streaks AS (SELECT b.*, (SELECT MIN(e.current_season) FROM ends e WHERE e.player_name = b.player_name
                         AND e.current_season >= b.current_season) AS until FROM begins b)
"""


@query("d05_scd2_streaks", oracle=_streaks_sql("scoring_class") + """
SELECT player_name, scoring_class, current_season AS start_date, until AS end_date FROM streaks
""")
def d05_scd2_streaks(t):
    """Streaks of equal scoring class per player (SCD2 generation)."""
    h = player_history(t).select("player_name", "current_season", "scoring_class")
    return scd.scd2_streaks(h, "player_name", "current_season", ["scoring_class"])


@query("d09_scd2_incremental", headline=True, oracle=_streaks_sql("scoring_class", "is_active") + f"""
SELECT player_name, scoring_class, is_active, current_season AS start_season, until AS end_season,
       CAST({LAST_SEASON_SQL} AS BIGINT) AS current_season
FROM streaks
""")
def d09_scd2_incremental(t):
    """Last season's SCD (class, active) plus this season's snapshot -> this
    season's SCD.  Both come from one history, built once."""
    end = last_season(t)
    h = player_history(t).select("player_name", "current_season", "scoring_class", "is_active").checkpoint()
    prev_scd = (scd.scd2_streaks(h.where(F.col("current_season") < end), "player_name", "current_season",
                                 ["scoring_class", "is_active"], "start_season", "end_season")
                   .withColumn("current_season", F.lit(end - 1).cast("bigint")))
    return scd.scd2_incremental(prev_scd, h.where(F.col("current_season") == end), "player_name",
                                ["scoring_class", "is_active"], end)


# ------------------------------------------------------------------ actors

_YEARLY_SQL = with_views("actor_films") + """,
yearly AS (SELECT actorid, year, MAX(actor) AS actor,
                  SUM(CAST(round(rating * 100) AS BIGINT)) AS rc, COUNT(*) AS num_films
           FROM actor_films GROUP BY actorid, year)
"""

_ACTORS_SQL = _YEARLY_SQL + """,
firsts AS (SELECT actorid, MIN(year) AS first_year, MAX(actor) AS actor
           FROM yearly WHERE year <= {end} GROUP BY actorid),
spine AS (SELECT actorid, actor, unnest(generate_series(first_year, {end})) AS year FROM firsts),
x AS (SELECT s.actorid, s.actor, s.year, y.year AS y_year, y.num_films
      FROM spine s LEFT JOIN yearly y ON s.actorid = y.actorid AND s.year = y.year),
r AS (SELECT *, COUNT(y_year) OVER w AS num_film_years, SUM(num_films) OVER w AS total_films,
             MAX(y_year) OVER w AS last_year
      FROM x WINDOW w AS (PARTITION BY actorid ORDER BY year
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
actors AS (
  SELECT r.actorid, r.actor, CAST(r.num_film_years AS BIGINT) AS num_film_years,
         CAST(r.total_films AS BIGINT) AS total_films,
         CASE WHEN y.rc > 800 * y.num_films THEN 'star' WHEN y.rc > 700 * y.num_films THEN 'good'
              WHEN y.rc > 600 * y.num_films THEN 'average' ELSE 'bad' END AS quality_class,
         CAST(r.year - r.last_year AS BIGINT) AS years_since_last_active,
         r.last_year = r.year AS is_active, CAST(r.year AS BIGINT) AS current_year
  FROM r JOIN yearly y ON y.actorid = r.actorid AND y.year = r.last_year)
"""


def actor_history(t, end=None, with_films=False):
    end = last_season(t) if end is None else end
    films = A.actor_films(t).where(F.col("year") <= end)
    return dims.actor_history(films, end, with_films=with_films)


def _actor_out(df):
    return df.select("actorid", "actor",
                     F.size("film_years").cast("bigint").alias("num_film_years"),
                     F.aggregate("film_years", F.lit(0).cast("bigint"),
                                 lambda a, x: a + x["num_films"]).alias("total_films"),
                     "quality_class", "years_since_last_active", "is_active", "current_year")


@query("d03_yearly_dimension", oracle=_YEARLY_SQL + """
SELECT actorid, year, actor, CAST(num_films AS BIGINT) AS num_films,
       CAST((rc * 2000000 + num_films * 100) // (num_films * 200) AS DOUBLE) / 1000000 AS avg_rating,
       CASE WHEN rc > 800 * num_films THEN 'star' WHEN rc > 700 * num_films THEN 'good'
            WHEN rc > 600 * num_films THEN 'average' ELSE 'bad' END AS quality_class,
       TRUE AS is_active
FROM yearly
""")
def d03_yearly_dimension(t):
    """Actor-year rows: films as a struct array, class by average rating."""
    y = dims.yearly_dimension(A.actor_films(t))
    return y.select("actorid", "year", "actor", "num_films",
                    olap.round_ratio(F.col("rating_c_sum"), F.col("num_films") * 100, 6)
                    .alias("avg_rating"),
                    dims.quality_class(F.struct("rating_c_sum", "num_films")).alias("quality_class"),
                    F.lit(True).alias("is_active"))


@query("d04_cumulative_actors", oracle=_ACTORS_SQL.format(end=LAST_SEASON_SQL) + "SELECT * FROM actors")
def d04_cumulative_actors(t):
    """Cumulative actors table: films accumulate, inactive years carried."""
    return _actor_out(actor_history(t, with_films=True))


_SCD_ACTORS_SQL = _ACTORS_SQL.format(end=LAST_SEASON_SQL) + """,
chg AS (
  SELECT *, ROW_NUMBER() OVER w = 1
            OR LAG(quality_class) OVER w IS DISTINCT FROM quality_class
            OR LAG(is_active) OVER w IS DISTINCT FROM is_active AS changed
  FROM actors WINDOW w AS (PARTITION BY actorid ORDER BY current_year)),
kept AS (SELECT actorid, actor, quality_class, is_active,
                make_date(CAST(current_year AS INTEGER), 1, 1) AS start_date
         FROM chg WHERE changed),
hist AS (
  SELECT actorid, actor, quality_class, is_active, start_date,
         CAST(LEAD(start_date) OVER (PARTITION BY actorid ORDER BY start_date) - 1 AS DATE)
             AS end_date,
         LEAD(start_date) OVER (PARTITION BY actorid ORDER BY start_date) IS NULL
             AS current_flag
  FROM kept)
"""


def _actor_states(t):
    return actor_history(t).select("actorid", "actor", "current_year", "quality_class", "is_active")


def actor_scd(h):
    return scd.scd2_backfill(h, "actorid", "current_year", ["quality_class", "is_active"],
                             extra=["actor"])


@query("d06_scd2_backfill", headline=True, oracle=_SCD_ACTORS_SQL + "SELECT * FROM hist")
def d06_scd2_backfill(t):
    """Dated SCD2 history of actors (quality class, activity)."""
    return actor_scd(_actor_states(t))


@query("d08_scd2_apply", oracle=_SCD_ACTORS_SQL + "SELECT * FROM hist")
def d08_scd2_apply(t):
    """Apply the last year's actors snapshot to the SCD2 table built up to the
    year before; equals the full backfill.  Both come from one history, built once."""
    end, h = last_season(t), _actor_states(t).checkpoint()
    hist = actor_scd(h.where(F.col("current_year") < end))
    return scd.scd2_apply(hist, h.where(F.col("current_year") == end), "actorid", "quality_class", end, extra=["actor"])


@query("d07_scd2_changes", oracle=_ACTORS_SQL.format(end=LAST_SEASON_SQL) + """,
prev_chg AS (
  SELECT *, ROW_NUMBER() OVER w = 1
            OR LAG(quality_class) OVER w IS DISTINCT FROM quality_class
            OR LAG(is_active) OVER w IS DISTINCT FROM is_active AS changed
  FROM actors WHERE current_year < {y} WINDOW w AS (PARTITION BY actorid ORDER BY current_year)),
cur_scd AS (
  SELECT actorid, quality_class, is_active FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY actorid ORDER BY current_year DESC) AS rn
    FROM prev_chg WHERE changed) WHERE rn = 1)
SELECT n.actorid, n.quality_class, n.is_active,
       CASE WHEN c.actorid IS NULL THEN 'NEW_ACTOR'
            WHEN n.quality_class <> c.quality_class THEN 'QUALITY_CHANGED'
            WHEN n.is_active <> c.is_active THEN 'ACTIVITY_CHANGED'
            ELSE 'NO_CHANGE' END AS change_type
FROM actors n LEFT JOIN cur_scd c ON n.actorid = c.actorid
WHERE n.current_year = {y}
""".format(y=LAST_SEASON_SQL))
def d07_scd2_changes(t):
    """Classify this year's actors against their current SCD2 row."""
    end, h = last_season(t), _actor_states(t).checkpoint()
    new = h.where(F.col("current_year") == end).select("actorid", "quality_class", "is_active")
    return scd.scd2_changes(new, actor_scd(h.where(F.col("current_year") < end)), "actorid", "quality_class")


# The actor wording of the career states.
ACTOR_LABELS = {"new": "New Actor", "continued": "Continued Acting",
                "new_inactive": "New Actor (Inactive)"}

# The state is looked up by activity before and now; the first year has no before.
_STATE_SQL = _ACTORS_SQL.format(end=LAST_SEASON_SQL) + """,
states(before, now, label) AS (VALUES
  ('none', true, 'New Actor'), ('none', false, 'New Actor (Inactive)'),
  ('true', true, 'Continued Acting'), ('true', false, 'Retired'),
  ('false', true, 'Returned from Retirement'), ('false', false, 'Stayed Retired')),
known AS (FROM actors WHERE is_active IS NOT NULL),
debut AS (SELECT actorid, MIN(current_year) AS year FROM known GROUP BY actorid),
steps AS (SELECT actorid, current_year AS year, is_active,
                 ifnull(CAST(lag(is_active) OVER (PARTITION BY actorid ORDER BY current_year) AS VARCHAR), 'none')
                     AS before FROM known),
st AS (SELECT s.actorid, s.year, if(s.is_active, 'Active', 'Inactive') AS current_status,
              k.label AS status_change, CAST(s.year - d.year AS BIGINT) AS years_since_debut
       FROM steps s JOIN debut d USING (actorid) JOIN states k ON k.before = s.before AND k.now = s.is_active)
"""


def _states(t):
    h = actor_history(t).select("actorid", F.col("current_year").alias("year"), "is_active")
    return growth.state_changes(h, "actorid", "year", labels=ACTOR_LABELS)


@query("d30_state_changes", oracle=_STATE_SQL + "SELECT * FROM st")
def d30_state_changes(t):
    """Career state change per actor and year."""
    return _states(t)


@query("d31_state_change_summary", oracle=_STATE_SQL + """
SELECT status_change, COUNT(*) AS total_occurrences,
       CAST(ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS DOUBLE) AS percentage
FROM st GROUP BY status_change
""")
def d31_state_change_summary(t):
    """Counts and percentages per career state."""
    return growth.state_change_summary(_states(t))
