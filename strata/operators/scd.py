"""Slowly changing dimensions, type 2.

All forms find change points with ``lag`` over a key's periods.  Input rows
are one per (key, period) -- a snapshot table -- so each window partition is
bounded by the number of periods, not by data volume.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from strata.sources.sinks import close_rows


def _changed(cols: Sequence[str], w, null_safe: bool) -> F.Column:
    cond = None
    for c in cols:
        prev = F.lag(c).over(w)
        diff = ~prev.eqNullSafe(F.col(c)) if null_safe else (prev != F.col(c))
        cond = diff if cond is None else (cond | diff)
    return cond


def scd2_streaks(df: DataFrame, key: str, order: str, cols: Sequence[str],
                 start: str = "start_date", end: str = "end_date",
                 null_safe: bool = False) -> DataFrame:
    """Collapse consecutive periods with equal ``cols`` into streaks with
    min/max period.  As written in the source a streak starts where a value
    differs from the previous row (``<>``) or there is no previous row; with
    ``null_safe`` NULLs compare as values."""
    w = Window.partitionBy(key).orderBy(order)
    first = F.row_number().over(w) == 1
    did_change = first | _changed(cols, w, null_safe)
    x = df.withColumn("_chg", F.when(did_change, 1).otherwise(0))
    x = x.withColumn("_streak", F.sum("_chg").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (x.groupBy(key, *cols, "_streak")
              .agg(F.min(order).alias(start), F.max(order).alias(end))
              .drop("_streak"))


def scd2_backfill(df: DataFrame, key: str, year: str, cols: Sequence[str],
                  extra: Sequence[str] = ()) -> DataFrame:
    """Full SCD2 history with dates.  A change row is the first row of a
    key or one whose ``cols`` differ null-safely from the previous row; keep
    change rows; start = 1 Jan of the year, end = next kept start - 1 day
    (NULL for the last), current_flag = end IS NULL."""
    w = Window.partitionBy(key).orderBy(year)
    kept = (df.withColumn("_chg", (F.row_number().over(w) == 1) | _changed(cols, w, True))
              .where("_chg")
              .withColumn("start_date", F.make_date(F.col(year).cast("int"), F.lit(1), F.lit(1))))
    w2 = Window.partitionBy(key).orderBy("start_date")
    nxt = F.lead("start_date").over(w2)
    return kept.select(key, *extra, *cols, "start_date",
                       F.date_sub(nxt, 1).alias("end_date"),
                       nxt.isNull().alias("current_flag"))


# The change classes of the incremental SCD load.
CHANGE_TYPES = ("NEW_ACTOR", "QUALITY_CHANGED", "ACTIVITY_CHANGED", "NO_CHANGE")


def scd2_changes(new: DataFrame, current: DataFrame, key: str, class_col: str,
                 active_col: str = "is_active") -> DataFrame:
    """Classify each new row against the key's current SCD row, tested in
    order: no current row -> NEW_ACTOR; class differs -> QUALITY_CHANGED; activity
    differs -> ACTIVITY_CHANGED; else NO_CHANGE."""
    cur = current.where("current_flag").select(
        key, F.col(class_col).alias("_cur_class"), F.col(active_col).alias("_cur_active"),
        F.lit(True).alias("_has_cur"))
    j = new.join(cur, key, "left")
    ct = (F.when(F.col("_has_cur").isNull(), "NEW_ACTOR")
           .when(~F.col(class_col).eqNullSafe(F.col("_cur_class")), "QUALITY_CHANGED")
           .when(~F.col(active_col).eqNullSafe(F.col("_cur_active")), "ACTIVITY_CHANGED")
           .otherwise("NO_CHANGE"))
    return j.withColumn("change_type", ct).drop("_cur_class", "_cur_active", "_has_cur")


def scd2_apply(history: DataFrame, new: DataFrame, key: str, class_col: str,
               year: int, active_col: str = "is_active", extra: Sequence[str] = ()) -> DataFrame:
    """Apply one year's snapshot to a dated SCD2 table as one new version.

    Changed current rows are closed at 31 Dec of ``year - 1`` (left join of
    the history to the changed keys, then a ``when`` rewrite -- the UPDATE of
    the source); changed and new keys get an open row from 1 Jan of ``year``;
    everything else passes through.  The caller writes the result to a new
    path (never overwriting the table it reads)."""
    ch = scd2_changes(new, history, key, class_col, active_col)
    moved = ch.where(F.col("change_type") != "NO_CHANGE")
    changed_keys = moved.where(F.col("change_type") != "NEW_ACTOR").select(key)
    closed = close_rows(history.select(key, *extra, class_col, active_col, "start_date",
                                       "end_date", "current_flag"),
                        changed_keys, [key], "end_date",
                        _dt.date(year - 1, 12, 31), "current_flag")
    opened = moved.select(key, *extra, class_col, active_col,
                          F.make_date(F.lit(year), F.lit(1), F.lit(1)).alias("start_date"),
                          F.lit(None).cast("date").alias("end_date"),
                          F.lit(True).alias("current_flag"))
    return closed.unionByName(opened)


def scd2_incremental(prev_scd: DataFrame, cur: DataFrame, key: str, cols: Sequence[str],
                     season: int, period: str = "current_season") -> DataFrame:
    """Season-based SCD2 step.  History rows closed before last season
    stay; rows open at last season are extended when unchanged, or kept and
    followed by a new (season, season) row when changed; new keys start a
    row.  Keys absent this season keep their rows (closed).  One output,
    stamped with ``current_season``."""
    last = season - 1
    scd = prev_scd.where(F.col(period) == last).drop(period)
    hist = scd.where(F.col("end_season") < last)
    open_ = scd.where(F.col("end_season") == last)
    ts = cur.where(F.col(period) == season).select(key, *cols)
    j = ts.alias("t").join(open_.alias("o"), key, "left")
    same = None
    for c in cols:
        e = F.col("t." + c).eqNullSafe(F.col("o." + c))
        same = e if same is None else same & e
    has_open = F.col("o.start_season").isNotNull()
    unchanged = j.where(has_open & same).select(
        key, *[F.col("t." + c).alias(c) for c in cols], F.col("o.start_season"),
        F.lit(season).cast("bigint").alias("end_season"))
    changed = j.where(has_open & ~same)
    changed_rows = changed.select(
        key, F.inline(F.array(
            F.struct(*[F.col("o." + c).alias(c) for c in cols],
                     F.col("o.start_season").alias("start_season"),
                     F.col("o.end_season").alias("end_season")),
            F.struct(*[F.col("t." + c).alias(c) for c in cols],
                     F.lit(season).cast("bigint").alias("start_season"),
                     F.lit(season).cast("bigint").alias("end_season")))))
    new_rows = j.where(~has_open).select(
        key, *[F.col("t." + c).alias(c) for c in cols],
        F.lit(season).cast("bigint").alias("start_season"),
        F.lit(season).cast("bigint").alias("end_season"))
    absent = open_.join(ts.select(key), key, "left_anti")
    out = (hist.unionByName(unchanged).unionByName(changed_rows)
               .unionByName(new_rows).unionByName(absent))
    return out.withColumn(period, F.lit(season).cast("bigint"))
