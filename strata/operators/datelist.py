"""Date lists and date-list bitmaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DateType

from strata.functions.columns import as_date, bit_count_masked, bits_of_dates, col_

# BIT(32) masks of the activity analysis (snapshot day = bit 31).
WEEK_MASK = 0xFE000000            # days 0..6 before the snapshot
PREV_WEEK_MASK = 0x01FC0000       # days 7..13 before the snapshot


def active_key_days(events: DataFrame, keys: Sequence[str], ts: str = "event_time",
                    until=None) -> DataFrame:
    """Distinct (keys..., day) with activity; rows with a NULL key dropped.
    The distinct is a hash aggregate with a map-side partial step."""
    e = events
    if until is not None:
        e = e.where(F.col(ts) < F.date_add(as_date(until), 1).cast("timestamp_ntz"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return e.where(cond).select(*keys, F.to_date(F.col(ts)).alias("day")).distinct()


def datelist_step(prev: DataFrame | None, events: DataFrame, keys: Sequence[str], ds,
                  ts: str = "event_time") -> DataFrame:
    """Snapshot ``ds`` = snapshot of ``ds - 1`` FULL JOIN the keys active
    on ``ds``; the day is appended when active (once, so a re-run is a no-op);
    the output date is ``ds`` for every row."""
    day = as_date(ds)
    lo, hi = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    cond = (F.col(ts) >= lo) & (F.col(ts) < hi)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    t = events.where(cond).select(*keys).distinct().withColumn("_today", day)
    empty = F.array().cast(ArrayType(DateType()))
    if prev is None:
        y = t.sparkSession.createDataFrame([], t.select(*keys).schema) \
             .withColumn("dates_active", empty)
    else:
        y = prev.where(F.col("date") == F.date_sub(day, 1)).select(*keys, "dates_active")
    j = t.join(y, list(keys), "full")
    dates = F.coalesce(F.col("dates_active"), empty)
    add = F.col("_today").isNotNull() & ~F.array_contains(dates, F.col("_today"))
    return j.select(*keys,
                    F.when(add, F.array_append(dates, F.col("_today"))).otherwise(dates)
                    .alias("dates_active"),
                    day.alias("date"))


def datelist_history(events: DataFrame, keys: Sequence[str], end_ds,
                     ts: str = "event_time") -> DataFrame:
    """Every daily snapshot from each key's first active day to
    ``end_ds`` in one pass (no loop over days): distinct key-days, a per-key
    date spine, and a running ``collect_list`` of active days.  The window
    per key is bounded by the number of days in the range."""
    end = as_date(end_ds)
    act = active_key_days(events, keys, ts, until=end_ds)
    first = act.groupBy(*keys).agg(F.min("day").alias("_first"))
    spine = first.select(*keys, F.explode(F.sequence("_first", end)).alias("date"))
    a = act.withColumn("_a", F.col("day"))
    x = spine.join(a.withColumnRenamed("day", "date"), list(keys) + ["date"], "left")
    w = (Window.partitionBy(*keys).orderBy("date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return x.select(*keys, F.collect_list("_a").over(w).alias("dates_active"), "date")


def datelist_int(snapshot: DataFrame, width: int = 32, dates: str = "dates_active",
                 date: str = "date") -> DataFrame:
    """Date array -> bitmap of the ``width`` days ending at the snapshot
    date (snapshot day = most significant bit).  A higher-order function over
    each row's own array: no cross join with a date spine, no shuffle."""
    return snapshot.withColumn("datelist_int", bits_of_dates(col_(dates), col_(date), width))


def activity_from_bits(df: DataFrame, bits: str = "datelist_int") -> DataFrame:
    """monthly/weekly activity flags and counts from the bitmap."""
    b = F.col(bits)
    l32 = F.bit_count(b).cast("bigint")
    l7 = bit_count_masked(b, WEEK_MASK)
    prev7 = bit_count_masked(b, PREV_WEEK_MASK)
    return df.select("*", (l32 > 0).alias("monthly_active"), l32.alias("l32"),
                     (l7 > 0).alias("weekly_active"), l7.alias("l7"),
                     (prev7 > 0).alias("weekly_active_previous_week"))


def datelist_map(snapshot: DataFrame, key: str, map_key: str, dates: str = "dates_active",
                 date: str = "date") -> DataFrame:
    """The MAP<STRING, ARRAY<DATE>> form of a two-key date list: one row per
    ``key`` and snapshot date with ``map_key -> dates``.  The map of a key
    holds one entry per distinct ``map_key`` value of that key (e.g. the
    user's browsers), so it is bounded by that small domain."""
    return (snapshot.groupBy(key, date)
                    .agg(F.map_from_entries(F.collect_list(F.struct(F.col(map_key), F.col(dates))))
                         .alias(dates + "_by_" + map_key)))
