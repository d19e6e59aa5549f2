"""Dashboards and ranked reports: grouping sets, rolling windows, streaks and
trends (D28, D29, D32, D34-D36, A5-A7, W1-W15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.functions.columns import RATING_TIERS, fill_unknown, normalize_referrer, tier
from strata.operators.relational import keyed_sequence, top_k

# ------------------------------------------------------------- exact rounding


def _whole(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("decimal(38,0)")


def round_ratio(num, den, digits: int) -> Column:
    """``round(num / den, digits)`` half-up, exact for non-negative integer
    ``num`` and positive integer ``den``: integral division of 38-digit
    decimals, so any engine gets the same value at any group size (a division
    of doubles would round near-ties by accident)."""
    scale = 10 ** digits
    n, d = _whole(num), _whole(den)
    q = F.call_function("div", _whole(n * (2 * scale) + d), _whole(d * 2))
    return (q.cast("double") / float(scale))


def hundredths(c) -> Column:
    """A 2-decimal double as an exact integer count of hundredths."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


# ---------------------------------------------------------- D28 grouping sets

# Aggregation-level labels of the device dashboard.
DASHBOARD_LEVELS = ["os_type__device_type__browser", "browser_type", "device_type", "os_type"]


def device_dashboard(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Hits by (browser, device, os), browser, os and device in one
    aggregation (Expand + one hash aggregate), missing dims shown as
    '(overall)'."""
    e = events.join(devices, "device_id").select(
        fill_unknown("os_type").alias("os_type"), fill_unknown("device_type").alias("device_type"),
        fill_unknown("browser_type").alias("browser_type"))
    # the sets expand the few distinct combinations, not the events
    e = e.groupBy("browser_type", "device_type", "os_type").agg(F.count(F.lit(1)).alias("_n"))
    g = e.groupingSets([["browser_type", "device_type", "os_type"], ["browser_type"],
                        ["os_type"], ["device_type"]],
                       "browser_type", "device_type", "os_type") \
         .agg(F.sum("_n").alias("number_of_hits"),
              F.grouping("os_type").alias("_go"), F.grouping("device_type").alias("_gd"),
              F.grouping("browser_type").alias("_gb"))
    level = (F.when((F.col("_go") == 0) & (F.col("_gd") == 0) & (F.col("_gb") == 0),
                    DASHBOARD_LEVELS[0])
              .when(F.col("_gb") == 0, DASHBOARD_LEVELS[1])
              .when(F.col("_gd") == 0, DASHBOARD_LEVELS[2])
              .when(F.col("_go") == 0, DASHBOARD_LEVELS[3]))
    return g.select(level.alias("aggregation_level"),
                    F.coalesce("os_type", F.lit("(overall)")).alias("os_type"),
                    F.coalesce("device_type", F.lit("(overall)")).alias("device_type"),
                    F.coalesce("browser_type", F.lit("(overall)")).alias("browser_type"),
                    "number_of_hits")


# ---------------------------------------------------------- D29 rolling windows


def referrer_rolling(events: DataFrame, devices: DataFrame, on_site_patterns: Sequence[str],
                     min_total: int = 500, prev_week: tuple[int, int] = (-13, -7)) -> DataFrame:
    """Daily counts per (url, referrer) with a 7-row rolling sum, the
    previous week's sum, share of the month and of the total.  Counts are
    aggregated first, so every window runs over at most one row per day of
    one (referrer, url) group."""
    e = events.join(devices, "device_id").select(
        "url", normalize_referrer("referrer", on_site_patterns).alias("referrer"),
        F.to_date("event_time").alias("event_date"))
    daily = e.groupBy("url", "referrer", "event_date").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("referrer", "url").orderBy("event_date")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    month = Window.partitionBy("referrer", "url", F.trunc("event_date", "month"))
    x = daily.select(
        "referrer", "url", "event_date", "count",
        F.sum("count").over(w.rowsBetween(-6, 0)).alias("weekly_rolling_count"),
        F.sum("count").over(w.rowsBetween(*prev_week)).alias("previous_weekly_rolling_count"),
        F.sum("count").over(month).alias("_month"),
        F.sum("count").over(whole).alias("_total"))
    return (x.where((F.col("_total") > min_total) & F.col("referrer").isNotNull())
             .select("referrer", "url", "event_date", "count", "weekly_rolling_count",
                     "previous_weekly_rolling_count",
                     (F.col("count") / F.col("_month")).alias("pct_of_month"),
                     (F.col("count") / F.col("_total")).alias("pct_of_total")))


# ------------------------------------------------------------- D32 film cube

CUBE_LABELS = {  # fixed values: (grouping(actor), grouping(year), grouping(tier)) -> label
    (0, 0, 0): "Actor + Year + Quality Tier",
    (0, 0, 1): "Actor + Year (All Qualities)",
    (0, 1, 0): "Actor + Quality Tier (All Years)",
    (1, 0, 0): "Year + Quality Tier (All Actors)",
    (0, 1, 1): "Actor Only (Career Total)",
    (1, 0, 1): "Year Only (Industry Total)",
    (1, 1, 0): "Quality Tier Only (All Time)",
    (1, 1, 1): "Grand Total",
}
TIER_NAMES = {  # fixed values: film quality tier labels, by RATING_TIERS threshold
    "Excellent": "Excellent (8.0+)", "Good": "Good (7.0-7.9)", "Average": "Average (6.0-6.9)",
    "Below Average": "Below Average (5.0-5.9)", "Poor": "Poor (<5.0)",
}


def film_tier(rating) -> Column:
    ladder = [(thr, TIER_NAMES[label]) for thr, label in RATING_TIERS]
    return tier(rating, ladder, TIER_NAMES["Poor"], inclusive=True)


def film_tiers_cube(films: DataFrame) -> DataFrame:
    """All eight grouping sets of (actor, year, quality tier) in one
    CUBE aggregate, labelled by ``grouping_id``."""
    f = (films.where(F.col("rating").isNotNull() & F.col("votes").isNotNull()
                     & F.col("year").isNotNull())
              .select("actor", "year", "rating", "votes", hundredths("rating").alias("_rc"),
                      film_tier("rating").alias("film_quality_tier")))
    # films are aggregated to the finest set first; the cube expands that
    fine = f.groupBy("actor", "year", "film_quality_tier").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_rc").alias("_rc"), F.sum("votes").alias("_votes"),
        F.max("rating").alias("_high"), F.min("rating").alias("_low"))
    g = fine.cube("actor", "year", "film_quality_tier").agg(
        F.sum("_n").alias("total_films"),
        F.sum("_rc").alias("_src"),
        F.sum("_votes").alias("total_votes"),
        F.max("_high").alias("highest_rated_film_rating"),
        F.min("_low").alias("lowest_rated_film_rating"),
        F.grouping_id("actor", "year", "film_quality_tier").alias("_gid"))
    label = None
    for (ga, gy, gt), text in CUBE_LABELS.items():
        gid = ga * 4 + gy * 2 + gt
        label = F.when(F.col("_gid") == gid, text) if label is None else label.when(F.col("_gid") == gid, text)
    return g.select("actor", "year", "film_quality_tier", "total_films",
                    round_ratio(F.col("_src"), F.col("total_films") * 100, 2).alias("avg_rating"),
                    "total_votes",
                    round_ratio("total_votes", "total_films", 0).alias("avg_votes_per_film"),
                    "highest_rated_film_rating", "lowest_rated_film_rating",
                    label.alias("analysis_level"))


def ranked(df: DataFrame, rank_keys: Sequence[Column], tie_break: Sequence[Column], k: int,
           name: str = "ranking") -> DataFrame:
    """Top-k by ``rank_keys`` (plus ``tie_break`` so the cut is deterministic)
    with ``RANK()`` over the same keys.  The rank is computed on the k kept
    rows only: every row ranked ahead of a kept row is itself kept, so the
    rank equals the rank among all rows, and no global window is needed."""
    top = top_k(df, list(rank_keys) + list(tie_break), k)
    return top.withColumn(name, F.rank().over(Window.partitionBy(F.lit(1)).orderBy(*rank_keys)))


def best_actor_years(films: DataFrame, min_films: int = 2, k: int = 10) -> DataFrame:
    """D32 report 1: actor-years with the best average rating."""
    f = films.where(F.col("rating").isNotNull() & F.col("year").isNotNull())
    g = f.groupBy("actor", "year").agg(F.count(F.lit(1)).alias("total_films"),
                                       F.sum(hundredths("rating")).alias("_s"),
                                       F.sum("votes").alias("total_votes")) \
         .where(F.col("total_films") >= min_films) \
         .withColumn("avg_rating", round_ratio(F.col("_s"), F.col("total_films") * 100, 2)).drop("_s")
    return ranked(g, [F.desc("avg_rating"), F.desc("total_films")],
                  [F.asc("actor"), F.asc("year")], k)


def most_excellent_actors(films: DataFrame, min_films: int = 3, k: int = 10) -> DataFrame:
    """D32 report 2: actors with the most excellent (>= 8.0) films."""
    f = films.where(F.col("rating") >= 8.0)
    g = f.groupBy("actor").agg(F.count(F.lit(1)).alias("excellent_films"),
                               F.sum(hundredths("rating")).alias("_s"),
                               F.sum("votes").alias("total_votes_excellent")) \
         .where(F.col("excellent_films") >= min_films) \
         .withColumn("avg_excellent_rating",
                     round_ratio(F.col("_s"), F.col("excellent_films") * 100, 2)).drop("_s")
    return ranked(g, [F.desc("excellent_films"), F.desc("avg_excellent_rating")],
                  [F.asc("actor")], k)


def best_years(films: DataFrame, min_films: int = 10, k: int = 15) -> DataFrame:
    """D32 report 3: years with the most excellent films (two rankings; the
    years table is one row per year, so its windows are tiny)."""
    f = films.where(F.col("rating").isNotNull() & F.col("year").isNotNull())
    g = f.groupBy("year").agg(
        F.count(F.lit(1)).alias("total_films"),
        F.count(F.when(F.col("rating") >= 8.0, 1)).alias("excellent_films"),
        F.count(F.when(F.col("rating") >= 7.0, 1)).alias("good_or_better_films"),
        F.sum(hundredths("rating")).alias("_s")).where(F.col("total_films") >= min_films)
    g = g.select("year", "total_films", "excellent_films", "good_or_better_films",
                 round_ratio(F.col("_s"), F.col("total_films") * 100, 2).alias("avg_rating"),
                 round_ratio(F.col("excellent_films") * 100, F.col("total_films"), 2)
                 .alias("pct_excellent"))
    w1 = Window.partitionBy(F.lit(1)).orderBy(F.desc("excellent_films"))
    w2 = Window.partitionBy(F.lit(1)).orderBy(F.desc("pct_excellent"))
    g = g.withColumn("rank_by_excellent_count", F.rank().over(w1)) \
         .withColumn("rank_by_excellent_percentage", F.rank().over(w2))
    return top_k(g, [F.desc("excellent_films"), F.asc("year")], k)


# ------------------------------------------------------- D34 best stretch


def film_order() -> list[Column]:
    return [F.col("year"), F.desc("votes"), F.col("film")]


def best_stretch(films: DataFrame, n: int = 5, min_hits: int = 3, k: int = 20,
                 key: str = "actorid", threshold: float = 7.0) -> DataFrame:
    """Most high-rated films in any full n-film stretch per entity.

    With running counts C(s) of hits and rating hundredths in film order
    (one ``keyed_sequence``, spread over tasks even for a prolific entity),
    the stretch ending at film s sums to C(s) - C(s - n): an equi join on
    (entity, s - n) instead of a ROWS window over the whole entity.  Only
    full stretches (s >= n) count."""
    f = films.where(F.col("rating").isNotNull() & F.col("year").isNotNull()).select(
        key, "actor", "year", "votes", "film",
        F.when(F.col("rating") >= threshold, 1).otherwise(0).cast("bigint").alias("_hit"),
        hundredths("rating").alias("_rc"))
    c = keyed_sequence(f, [key], film_order(), "_s", running=["_hit", "_rc"]).select(
        key, "actor", "_s", "_hit_cum", "_rc_cum")
    back = c.select(key, (F.col("_s") + n).alias("_s"), F.col("_hit_cum").alias("_hb"),
                    F.col("_rc_cum").alias("_rb"))
    s = (c.where(F.col("_s") >= n).join(back, [key, "_s"], "left")
          .select(key, "actor", "_s",
                  (F.col("_hit_cum") - F.coalesce("_hb", F.lit(0))).alias("hits"),
                  (F.col("_rc_cum") - F.coalesce("_rb", F.lit(0))).alias("_sum_rc")))
    s = s.withColumn("avg_rating", round_ratio(F.col("_sum_rc"), F.lit(n * 100), 2))
    best = (s.groupBy(key)
              .agg(F.max_by(F.struct("actor", "hits", "avg_rating"),
                            F.struct("hits", "avg_rating", -F.col("_s"))).alias("b"))
              .select(key, "b.*")
              .where(F.col("hits") >= min_hits))
    best = best.select("actor", F.col("hits").alias("max_quality_films_in_stretch"),
                       F.col("avg_rating").alias("avg_rating_best_stretch"))
    return ranked(best, [F.desc("max_quality_films_in_stretch"), F.desc("avg_rating_best_stretch")],
                  [F.asc("actor")], k, name="overall_rank")


# ----------------------------------------------------- D35 longest streaks


def longest_streaks(films: DataFrame, threshold: float = 7.0, min_len: int = 2, k: int = 15,
                    key: str = "actorid") -> DataFrame:
    """Islands of consecutive high-rated films (difference of
    two keyed sequences), longest per entity with its years, average and
    films (earliest streak wins ties), top k.

    Islands are measured with aggregates only; the ordered film text (the
    STRING_AGG of the source) is built afterwards for the k reported islands
    alone, by joining their (entity, island) keys -- at most k rows, so a
    broadcast of bounded size -- back to the films."""
    hq = F.when(F.col("rating") >= threshold, 1).otherwise(0).cast("bigint")
    f = films.where(F.col("rating").isNotNull() & F.col("year").isNotNull()).select(
        key, "actor", "year", "votes", "film", "rating", hq.alias("_hq"))
    # the position among the entity's high-rated films is the running count of
    # them in film order, so one keyed sequence gives both row numbers
    f = keyed_sequence(f, [key], film_order(), "film_sequence", running="_hq")
    f = f.where(F.col("_hq") == 1).withColumn("_grp", F.col("film_sequence") - F.col("_hq_cum"))
    isl = (f.groupBy(key, "_grp")
            .agg(F.max("actor").alias("actor"), F.count(F.lit(1)).alias("streak_length"),
                 F.min("year").alias("start_year"), F.max("year").alias("end_year"),
                 F.sum(hundredths("rating")).alias("_s"))
            .where(F.col("streak_length") >= min_len))
    isl = isl.withColumn("avg_rating", round_ratio(F.col("_s"), F.col("streak_length") * 100, 2))
    best = (isl.groupBy(key)
               .agg(F.max_by(F.struct("actor", "streak_length", "start_year", "end_year",
                                      "avg_rating", "_grp"),
                             F.struct("streak_length", -F.col("_grp"))).alias("b"))
               .select(key, "b.*"))
    best = best.select(key, "_grp", "actor",
                       F.col("streak_length").alias("consecutive_high_quality_films"),
                       F.col("start_year").alias("best_streak_start_year"),
                       F.col("end_year").alias("best_streak_end_year"),
                       F.col("avg_rating").alias("best_streak_avg_rating"))
    top = ranked(best, [F.desc("consecutive_high_quality_films"), F.desc("best_streak_avg_rating")],
                 [F.asc("actor")], k, name="streak_rank")
    text = (f.join(F.broadcast(top.select(key, "_grp")), [key, "_grp"])
             .groupBy(key, "_grp")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                 F.struct("film_sequence", "film"))), lambda x: x["film"]), " | ")
                 .alias("best_streak_films")))
    return top.join(text, [key, "_grp"]).drop(key, "_grp")


# ------------------------------------------------------- D36 yearly trends


def percent_ranks_integral(df: DataFrame, part: str, values: Sequence[str],
                           outs: Sequence[str]) -> DataFrame:
    """W9 for several integer-valued columns at once: one count table per
    (part, v1, v2, ...) -- small, since the values are few distinct integers
    -- gives, with ``RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING``
    frames, the number of rows with a smaller value for each column; a single
    join brings ``<out>`` (the PERCENT_RANK), ``<out>_less`` and ``<out>_n``
    back to the rows."""
    c = df.groupBy(part, *values).agg(F.count(F.lit(1)).alias("_c"))
    n = F.sum("_c").over(Window.partitionBy(part))
    cols = [part, *values, n.alias("_n")]
    for v, o in zip(values, outs):
        less = F.coalesce(F.sum("_c").over(
            Window.partitionBy(part).orderBy(v).rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cols.append(less.alias(o + "_less"))
    c = c.select(*cols)
    for o in outs:
        c = c.withColumn(o, F.when(F.col("_n") <= 1, F.lit(0.0))
                            .otherwise(F.col(o + "_less") / (F.col("_n") - 1))) \
             .withColumn(o + "_n", F.col("_n"))
    return df.join(c.drop("_n"), [part, *values])


def _rolling3_mean_of_means(w) -> Column:
    """ROUND(AVG(AVG(rating)) over the current and two previous years, 2),
    exactly: with s_i hundredths summed over n_i films per year, 100 x the
    mean is (sum_i s_i / n_i) / k = N / D over a common denominator, rounded
    half-up in integers."""
    # three factors of up to 12 digits each: a bigint would overflow
    wide = lambda c: c.cast("decimal(19,0)")
    s0, n0 = wide(F.col("_s")), wide(F.col("films_that_year"))
    s1, n1 = wide(F.lag("_s", 1).over(w)), wide(F.lag("films_that_year", 1).over(w))
    s2, n2 = wide(F.lag("_s", 2).over(w)), wide(F.lag("films_that_year", 2).over(w))
    num = (F.when(n2.isNotNull(), s0 * n1 * n2 + s1 * n0 * n2 + s2 * n0 * n1)
            .when(n1.isNotNull(), s0 * n1 + s1 * n0).otherwise(s0))
    den = (F.when(n2.isNotNull(), n0 * n1 * n2 * 3)
            .when(n1.isNotNull(), n0 * n1 * 2).otherwise(n0))
    return round_ratio(num, den, 0) / 100.0


# The trend labels.
ACTIVITY_TRENDS = ("↗ More Active", "→ Same Activity", "↘ Less Active")
QUALITY_TRENDS = ("↗ Much Better", "↗ Better", "→ Similar", "↘ Worse")


def yearly_trends(films: DataFrame, key: str = "actorid", k: int = 25,
                  top_share: float = 0.8) -> DataFrame:
    """Per entity-year count and average, year-over-year change,
    3-year rolling means, percentile ranks within the year, trend labels;
    keep the top 20 % by rating or productivity."""
    f = films.where(F.col("rating").isNotNull() & F.col("year").isNotNull())
    y = f.groupBy(key, "year").agg(F.max("actor").alias("actor"),
                                   F.count(F.lit(1)).alias("films_that_year"),
                                   F.sum(hundredths("rating")).alias("_s"))
    y = y.withColumn("_avg_c", round_ratio("_s", "films_that_year", 0).cast("bigint"))
    w = Window.partitionBy(key).orderBy("year")
    y = (y.withColumn("career_year_number", F.row_number().over(w).cast("bigint"))
          .withColumn("_prev_n", F.lag("films_that_year").over(w))
          .withColumn("_prev_avg_c", F.lag("_avg_c").over(w))
          .withColumn("rolling_3yr_avg_rating", _rolling3_mean_of_means(w))
          .withColumn("_r3n_s", F.sum("films_that_year").over(w.rowsBetween(-2, 0)))
          .withColumn("_r3n_k", F.count(F.lit(1)).over(w.rowsBetween(-2, 0))))
    y = y.where(F.col("career_year_number") >= 2).select(
        key, "actor", "year", "films_that_year", "career_year_number",
        (F.col("_avg_c") / 100.0).alias("avg_rating_that_year"), "_avg_c",
        (F.col("films_that_year") - F.coalesce("_prev_n", F.lit(0))).alias("_dn"),
        (F.col("_avg_c") - F.coalesce("_prev_avg_c", F.lit(0))).alias("_dr"),
        "rolling_3yr_avg_rating",
        round_ratio("_r3n_s", "_r3n_k", 1).alias("rolling_3yr_avg_films_per_year"))
    y = percent_ranks_integral(y, "year", ["_avg_c", "films_that_year"], ["_pr", "_pp"])
    more, equal, less = ACTIVITY_TRENDS
    activity = F.when(F.col("_dn") > 0, more).when(F.col("_dn") < 0, less).otherwise(equal)
    much, better, similar, worse = QUALITY_TRENDS
    quality = (F.when(F.col("_dr") >= 50, much).when(F.col("_dr") > 0, better)
                .when(F.col("_dr") >= -50, similar).otherwise(worse))
    pct = lambda p: F.when(F.col(p + "_n") <= 1, F.lit(0.0)).otherwise(
        round_ratio(F.col(p + "_less") * 100, F.col(p + "_n") - 1, 1))
    out = y.where((F.col("_pr") >= top_share) | (F.col("_pp") >= top_share)).select(
        "actor", "year", "films_that_year", "avg_rating_that_year", "career_year_number",
        activity.alias("activity_trend"), quality.alias("quality_trend"),
        "rolling_3yr_avg_rating", "rolling_3yr_avg_films_per_year",
        pct("_pr").alias("rating_percentile"), pct("_pp").alias("productivity_percentile"))
    return top_k(out, [F.desc("year"), F.desc("avg_rating_that_year"), F.asc("actor")], k)
