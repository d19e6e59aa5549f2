"""Growth accounting, retention, funnels and state changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strata.functions.columns import as_date

# ---------------------------------------------------------------- D27 funnel


def funnel(events: DataFrame, target_url: str, min_rows: int = 100,
           user="user_id", ts="event_time", url="url", host="host") -> DataFrame:
    """Per page, the share of (user, moment, page) units that are followed
    later the same day by a visit to ``target_url``.

    Semantics of the self-join form: rows distinct on (url, host, user, time)
    with a user; a unit is a distinct (user, time, url); it counts only if the
    user has a strictly later event the same day, and converts if one of those
    later events is the target.  Keep pages with rate > 0 and units > min_rows.

    Plan: instead of the quadratic self-join, aggregate per (user, day) the
    latest event time and the latest target time (hash aggregate with map-side
    partial aggregation, so a hot user is pre-reduced before the shuffle), join
    that one row per (user, day) back to the units and compare times.
    """
    e = (events.where(F.col(user).isNotNull())
               .select(F.col(user).alias("user_id"), F.col(ts).alias("t"),
                       F.col(url).alias("url"))
               .withColumn("d", F.to_date("t")))
    per_day = (e.groupBy("user_id", "d")
                .agg(F.max("t").alias("last_t"),
                     F.max(F.when(F.col("url") == target_url, F.col("t"))).alias("last_target_t")))
    units = e.select("user_id", "t", "url", "d").distinct()
    scored = (units.join(per_day, ["user_id", "d"])
                   .where(F.col("last_t") > F.col("t"))
                   .select("url", F.when(F.col("last_target_t") > F.col("t"), 1).otherwise(0)
                           .alias("converted")))
    out = (scored.groupBy("url")
                 .agg(F.count(F.lit(1)).alias("num_units"),
                      (F.sum("converted") / F.count(F.lit(1))).alias("conversion_rate")))
    return out.where((F.col("conversion_rate") > 0) & (F.col("num_units") > min_rows))


# ------------------------------------------------------ D25 growth accounting

GA_COLS = ["user_id", "first_active_date", "last_active_date", "daily_active_state",
           "weekly_active_state", "dates_active", "date"]


def _daily_state(y_exists, y_last, y_date, today):
    """CASE ladder of the daily state, in source order."""
    return (F.when(~y_exists, "New")
             .when(y_last == F.date_sub(today, 1), "Retained")
             .when(y_last < F.date_sub(today, 1), "Resurrected")
             .when(today.isNull() & (y_last == y_date), "Churned")
             .otherwise("Stale"))


def _weekly_state(y_exists, y_last, y_date, today):
    """CASE ladder of the weekly state, in source order (Resurrected, Churned,
    Retained, Stale)."""
    return (F.when(~y_exists, "New")
             .when(y_last < F.date_sub(today, 7), "Resurrected")
             .when(today.isNull() & (y_last == F.date_sub(y_date, 7)), "Churned")
             .when(F.date_add(F.coalesce(today, y_last), 7) >= y_date, "Retained")
             .otherwise("Stale"))


def active_days(events: DataFrame, user="user_id", ts="event_time") -> DataFrame:
    """Distinct (user_id, day) with activity; NULL users dropped."""
    return (events.where(F.col(user).isNotNull())
                  .select(F.col(user).alias("user_id"), F.to_date(F.col(ts)).alias("day"))
                  .distinct())


def growth_accounting_step(prev: DataFrame | None, events: DataFrame, ds,
                           user="user_id", ts="event_time") -> DataFrame:
    """D25, one daily step: yesterday's snapshot FULL JOIN today's actives.

    ``prev`` has GA_COLS (``None`` on the first day).  The events filter is a
    half-open timestamp range so it is pushed to the scan.
    """
    day = as_date(ds)
    lo, hi = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    t = (events.where((F.col(ts) >= lo) & (F.col(ts) < hi) & F.col(user).isNotNull())
               .select(F.col(user).alias("user_id")).distinct()
               .withColumn("today", day))
    if prev is None:
        y = t.sparkSession.createDataFrame(
            [], "user_id bigint, first_active_date date, last_active_date date, "
                "dates_active array<date>, date date")
    else:
        # only yesterday's snapshot counts, whatever else the table keeps
        y = prev.where(F.col("date") == F.date_sub(day, 1)).select(
            "user_id", "first_active_date", "last_active_date", "dates_active", "date")
    y = y.withColumn("_y", F.lit(True))
    j = t.join(y, "user_id", "full")
    y_exists = F.col("_y").isNotNull()
    today = F.col("today")
    return j.select(
        "user_id",
        F.coalesce("first_active_date", "today").alias("first_active_date"),
        F.coalesce("today", "last_active_date").alias("last_active_date"),
        _daily_state(y_exists, F.col("last_active_date"), F.col("date"), today)
        .alias("daily_active_state"),
        _weekly_state(y_exists, F.col("last_active_date"), F.col("date"), today)
        .alias("weekly_active_state"),
        F.array_union(F.coalesce("dates_active", F.array().cast("array<date>")),
                      F.when(today.isNotNull(), F.array(today))
                       .otherwise(F.array().cast("array<date>"))).alias("dates_active"),
        F.coalesce(today, F.date_add("date", 1)).alias("date"),
    )


def growth_accounting_history(events: DataFrame, end_ds, user="user_id",
                              ts="event_time") -> DataFrame:
    """D25 for every day at once: the snapshot rows the daily step would
    produce from each user's first active day up to ``end_ds``.

    One pass: distinct active (user, day) -> per-user date spine -> running
    last-active date.  The window is per user ordered by day; its length is
    bounded by the number of days in the range (the spine), not by the number
    of events, so a hot user cannot blow up one task.
    """
    end = as_date(end_ds)
    act = active_days(events.where(F.col(ts) < F.date_add(end, 1).cast("timestamp_ntz")),
                      user, ts)
    first = act.groupBy("user_id").agg(F.min("day").alias("first_active_date"))
    spine = first.select("user_id", "first_active_date",
                         F.explode(F.sequence("first_active_date", end)).alias("date"))
    a = act.withColumn("_a", F.lit(True))
    x = spine.join(a, (spine.user_id == a.user_id) & (spine.date == a.day), "left") \
             .select(spine.user_id, "first_active_date", "date", F.col("_a").isNotNull().alias("active"))
    w = Window.partitionBy("user_id").orderBy("date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = (x.withColumn("last_active_date", F.max(F.when(F.col("active"), F.col("date"))).over(run))
          .withColumn("num_dates_active", F.count(F.when(F.col("active"), 1)).over(run))
          .withColumn("y_last", F.lag("last_active_date").over(w)))
    y_exists = F.col("date") > F.col("first_active_date")
    today = F.when(F.col("active"), F.col("date"))
    y_date = F.date_sub("date", 1)
    return x.select(
        "user_id", "first_active_date", "last_active_date",
        _daily_state(y_exists, F.col("y_last"), y_date, today).alias("daily_active_state"),
        _weekly_state(y_exists, F.col("y_last"), y_date, today).alias("weekly_active_state"),
        F.col("num_dates_active").cast("bigint").alias("num_dates_active"),
        "date")


def growth_accounting_snapshot(events: DataFrame, ds, user="user_id", ts="event_time") -> DataFrame:
    """D25, the snapshot of one day with its date lists (GA_COLS), from the events
    up to that day: what the daily steps arrive at, without the days between.
    A list holds a user's distinct active days, so it is bounded by the calendar."""
    day = as_date(ds)
    act = active_days(events.where(F.col(ts) < F.date_add(day, 1).cast("timestamp_ntz")), user, ts)
    x = act.groupBy("user_id").agg(
        F.min("day").alias("first_active_date"), F.max("day").alias("last_active_date"),
        F.max(F.when(F.col("day") < day, F.col("day"))).alias("_y_last"),
        F.array_sort(F.collect_list("day")).alias("dates_active"))
    known = F.col("_y_last").isNotNull()
    today = F.when(F.col("last_active_date") == day, day)
    return x.select("user_id", "first_active_date", "last_active_date",
                    _daily_state(known, F.col("_y_last"), F.date_sub(day, 1), today).alias("daily_active_state"),
                    _weekly_state(known, F.col("_y_last"), F.date_sub(day, 1), today).alias("weekly_active_state"),
                    "dates_active", day.alias("date"))


# ----------------------------------------------------------- D26 retention


def retention_curve(ga: DataFrame) -> DataFrame:
    """Share of users active by days since their first active day."""
    return (ga.groupBy(F.datediff("date", "first_active_date").cast("bigint")
                        .alias("days_since_first_active"))
              .agg((F.count(F.when(F.col("daily_active_state")
                                    .isin("Retained", "Resurrected", "New"), 1))
                    / F.count(F.lit(1))).alias("pct_active"),
                   F.count(F.lit(1)).alias("num_users")))


# ------------------------------------------------------- D30/D31 state changes

STATE_LABELS = {  # fixed values: the state names of the career tracker
    "new": "New", "retired": "Retired", "continued": "Continued Playing",
    "returned": "Returned from Retirement", "stayed": "Stayed Retired",
    "new_inactive": "New (Inactive)",
}


def state_changes(df: DataFrame, key: str, period: str, active: str = "is_active",
                  labels: dict | None = None) -> DataFrame:
    """Per key and period, the change of the active flag since the
    previous period.  The window is per key over its periods (one row per
    period after the spine), so its size is bounded by the number of periods."""
    lb = dict(STATE_LABELS, **(labels or {}))
    w = Window.partitionBy(key).orderBy(period)
    x = (df.where(F.col(active).isNotNull())
           .withColumn("_prev", F.lag(active).over(w))
           .withColumn("_first", F.min(period).over(Window.partitionBy(key))))
    a, p, first = F.col(active), F.col("_prev"), F.col(period) == F.col("_first")
    state = (F.when(first & (a == F.lit(True)), lb["new"])
              .when((p == F.lit(True)) & (a == F.lit(False)), lb["retired"])
              .when((p == F.lit(True)) & (a == F.lit(True)), lb["continued"])
              .when((p == F.lit(False)) & (a == F.lit(True)), lb["returned"])
              .when((p == F.lit(False)) & (a == F.lit(False)), lb["stayed"])
              .when(first & (a == F.lit(False)), lb["new_inactive"])
              .otherwise("Unknown Status"))
    return (x.select(key, period,
                     F.when(a, "Active").otherwise("Inactive").alias("current_status"),
                     state.alias("status_change"),
                     (F.col(period) - F.col("_first")).cast("bigint").alias("years_since_debut"))
             .where(F.col("status_change") != "Unknown Status"))


def state_change_summary(changes: DataFrame) -> DataFrame:
    """Occurrences per state and their share of all (2 decimals).  The
    grand total is a tiny aggregate (one row per state) so the global window
    runs on a handful of rows."""
    c = changes.groupBy("status_change").agg(F.count(F.lit(1)).alias("total_occurrences"))
    tot = F.sum("total_occurrences").over(Window.partitionBy(F.lit(1)))
    return c.select("status_change", "total_occurrences",
                    F.round(F.col("total_occurrences").cast("decimal(38,10)") * 100 / tot, 2)
                    .cast("double").alias("percentage"))
