"""Queries over scans in order, mergeable counts and repeatable samples (J6, L1,
W2, A2, L7), and the actors' films in chunks (D3, D4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.columns import array_text
from strata.operators import dims, growth, jobs, ordered, visitors
from strata.operators.sample import sample_keys
from strata.plans.dim_queries import _ACTORS_SQL, _YEARLY_SQL
from strata.plans.growth_queries import _GA_SQL
from strata.plans.oracle_views import with_views
from strata.plans.registry import query
from strata.plans.report import LAST_DAY_SQL, LAST_SEASON_SQL, last_day, last_season
from strata.sources import adapters as A


@query("j06_next_event", oracle=with_views("web_events") + """,
e AS (SELECT user_id, CAST(event_time AS DATE) AS day, event_time, url, host FROM web_events WHERE user_id IS NOT NULL),
d AS (SELECT DISTINCT user_id, day, event_time FROM e),
n AS (SELECT d.user_id, d.event_time, min({'t': x.event_time, 'url': x.url, 'host': x.host}) AS next
      FROM d JOIN e x ON x.user_id = d.user_id AND x.day = d.day AND x.event_time > d.event_time GROUP BY ALL)
SELECT e.user_id, e.event_time, e.url, e.host, n.next.t AS next_event_time, n.next.url AS next_url, n.next.host AS next_host
FROM e LEFT JOIN n ON n.user_id = e.user_id AND n.event_time = e.event_time
""")
def j06_next_event(t):
    """Every event with the same user's first later event of the day."""
    e = (A.web_events(t).where(F.col("user_id").isNotNull())
          .select("user_id", F.to_date("event_time").alias("day"), "event_time", "url", "host"))
    return ordered.next_event(e, ["user_id", "day"], "event_time", ["url", "host"]).drop("day")


@query("l01_rank_mixed_order", oracle=with_views("web_events") + """,
c AS (SELECT user_id, host, COUNT(*) AS n, MIN(referrer) AS referrer FROM web_events GROUP BY user_id, host)
SELECT user_id, host, n, referrer,
       CAST(RANK() OVER (ORDER BY referrer ASC NULLS LAST, n DESC, user_id DESC NULLS FIRST) AS INTEGER) AS place FROM c
""")
def l01_rank_mixed_order(t):
    """A global rank by keys of mixed direction with explicit null places."""
    c = A.web_events(t).groupBy("user_id", "host").agg(F.count(F.lit(1)).alias("n"), F.min("referrer").alias("referrer"))
    return ordered.ranks(c, [("referrer", "asc nulls last"), ("n", "desc"), ("user_id", "desc nulls first")], "place")


@query("a02_monthly_visitors", oracle=with_views("web_events") + """
SELECT host, date_trunc('month', event_time)::DATE AS month_start, COUNT(DISTINCT user_id) AS unique_users
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2
""")
def a02_monthly_visitors(t):
    """Monthly unique visitors per host from daily bitmap states (A2)."""
    states = visitors.daily_states(A.web_events(t), ["host"])
    return visitors.unique_over(states, ["host"], F.trunc("day", "month"), "month_start")


@query("l07_sample_orders", oracle="""
WITH h AS (SELECT *, ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM lineitem),
k AS (SELECT DISTINCT l_orderkey, h FROM h ORDER BY h, l_orderkey LIMIT 500)
SELECT l_orderkey, m.l_linenumber, m.l_partkey
FROM (SELECT l_orderkey, min({'l_linenumber': l_linenumber, 'l_partkey': l_partkey}) AS m
      FROM h WHERE l_orderkey IN (SELECT l_orderkey FROM k) GROUP BY l_orderkey)
""")
def l07_sample_orders(t):
    """500 orders by hash, each with its first line: the same in every run."""
    return sample_keys(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], 500)


CHUNK_FILMS = 4          # small, so that the test tables have entities of several chunks


@query("d03_film_chunks", oracle=_YEARLY_SQL + f""",
c AS (SELECT f.actorid, f.year, f.film,
             CAST(('0x' || substr(md5(f.filmid), 1, 15))::BIGINT % ((y.num_films + {CHUNK_FILMS - 1}) // {CHUNK_FILMS}) AS INTEGER) AS chunk
      FROM actor_films f JOIN yearly y ON y.actorid = f.actorid AND y.year = f.year)
SELECT actorid, year, chunk, COUNT(*) AS num_films, string_agg(film, ' | ' ORDER BY film) AS films
FROM c GROUP BY actorid, year, chunk
""")
def d03_film_chunks(t):
    """Films per actor and year in rows of bounded size."""
    c = dims.film_chunks(A.actor_films(t), CHUNK_FILMS)
    return c.select("actorid", "year", "chunk", F.size("films").cast("bigint").alias("num_films"),
                    F.array_join(F.transform("films", lambda x: x["film"]), " | ").alias("films"))


@query("d04_film_references", oracle=_ACTORS_SQL.format(end=LAST_SEASON_SQL) + f""",
refs AS (SELECT actorid, year, (num_films + {CHUNK_FILMS - 1}) // {CHUNK_FILMS} AS chunks FROM yearly)
SELECT a.actorid, a.current_year, a.quality_class, a.is_active, a.total_films,
       CAST(SUM(r.chunks) AS BIGINT) AS num_chunks, string_agg(r.year || ':' || r.chunks, ',' ORDER BY r.year) AS chunk_refs
FROM actors a JOIN refs r ON r.actorid = a.actorid AND r.year <= a.current_year GROUP BY ALL
""")
def d04_film_references(t):
    """Cumulative actors whose history refers to film chunks instead of copying
    the films of all earlier years into every row (D4)."""
    end = last_season(t)
    h = dims.actor_references(A.actor_films(t).where(F.col("year") <= end), end, CHUNK_FILMS)
    total = lambda f: F.aggregate("film_years", F.lit(0).cast("bigint"), lambda s, x: s + x[f])
    return h.select("actorid", "current_year", "quality_class", "is_active", total("num_films").alias("total_films"),
                    total("num_chunks").alias("num_chunks"),
                    F.array_join(F.transform("film_years", lambda x: F.concat_ws(":", x["year"].cast("string"), x["num_chunks"].cast("string"))), ",")
                    .alias("chunk_refs"))


@query("d25_growth_snapshot", oracle=_GA_SQL + f"""
SELECT g.user_id, g.first_active_date, g.last_active_date, g.daily_active_state, g.weekly_active_state,
       string_agg(CAST(a.day AS VARCHAR), ',' ORDER BY a.day) AS dates_active, g.date
FROM ga g JOIN act a ON a.user_id = g.user_id WHERE g.date = {LAST_DAY_SQL} GROUP BY ALL
""")
def d25_growth_snapshot(t):
    """The last day's growth states with every user's list of active dates."""
    s = growth.growth_accounting_snapshot(A.web_events(t), last_day(t))
    return s.withColumn("dates_active", array_text("dates_active"))


@query("d40_user_device_rows", oracle=with_views("web_events") + """,
agg AS (SELECT user_id, device_id, COUNT(*) AS n FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)
SELECT user_id, device_id, n AS event_counts, MAX(n) OVER (PARTITION BY user_id) AS total_hits,
       COUNT(*) OVER (PARTITION BY user_id) AS num_devices FROM agg
""")
def d40_user_device_rows(t):
    """Per user: the devices as (user, device) rows with the user's count and
    largest event count (D40)."""
    return jobs.user_device_rows(jobs.events_per_user_device(A.web_events(t).where(F.col("user_id").isNotNull())))
