"""Monthly metric arrays (D19-D24): one row per entity and month holding one
element per day of the month.

Arrays are positioned by day of month (element i = day i+1), so a skipped day
is a gap, not a shift, and re-running a day replaces its element instead of
appending a second one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.columns import as_date


def _pad_and_set(arr: Column, dom: Column, value: Column, fill) -> Column:
    """Array of exactly ``dom`` elements: the first dom-1 of ``arr`` (padded
    with ``fill``), then ``value``."""
    base = F.slice(F.coalesce(arr, F.array().cast("array<bigint>")), 1, dom - 1)
    pad = F.array_repeat(F.lit(fill).cast("bigint"), dom - 1 - F.size(base))
    return F.concat(base, pad, F.array(value))


def metric_step(prev: DataFrame | None, events: DataFrame, keys: Sequence[str], ds,
                fill=None, ts: str = "event_time", metric: Column | None = None,
                name: str = "metric_array", first_found: bool = True) -> DataFrame:
    """D19/D20 daily step: per key, this month's array with today's value set
    at position day-of-month (``fill`` -- NULL or 0 -- for padding and for
    keys without activity today)."""
    day = as_date(ds)
    month = F.trunc(day, "month")
    dom = F.dayofmonth(day)
    lo, hi = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    cond = (F.col(ts) >= lo) & (F.col(ts) < hi)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    m = metric if metric is not None else F.count(F.lit(1))
    t = events.where(cond).groupBy(*keys).agg(m.cast("bigint").alias("_v"))
    if prev is None:
        y = t.sparkSession.createDataFrame([], t.select(*keys).schema) \
             .withColumn(name, F.array().cast("array<bigint>")) \
             .withColumn("first_found_date", F.lit(None).cast("date"))
    else:
        y = prev.where(F.col("month_start") == month).select(*keys, name, "first_found_date")
    j = t.join(y, list(keys), "full")
    today_v = F.coalesce(F.col("_v"), F.lit(fill).cast("bigint"))
    out = j.select(*keys, month.alias("month_start"),
                   _pad_and_set(F.col(name), dom, today_v, fill).alias(name),
                   F.least(F.col("first_found_date"),
                           F.when(F.col("_v").isNotNull(), day)).alias("first_found_date"))
    return out if first_found else out.drop("first_found_date")


def metric_month(events: DataFrame, keys: Sequence[str], end_ds, fill=None,
                 ts: str = "event_time", metric: Column | None = None,
                 name: str = "metric_array") -> DataFrame:
    """D19/D20 for a whole month at once (backfill): per key active in the
    month up to ``end_ds``, an array of days 1..day(end_ds) with the day's value
    or ``fill``.  Daily values are a hash aggregate per (key, day); the array
    is assembled from at most 31 entries per key."""
    end = as_date(end_ds)
    month = F.trunc(end, "month")
    cond = (F.col(ts) >= month.cast("timestamp_ntz")) & \
           (F.col(ts) < F.date_add(end, 1).cast("timestamp_ntz"))
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    m = metric if metric is not None else F.count(F.lit(1))
    daily = (events.where(cond)
                   .groupBy(*keys, F.dayofmonth(F.col(ts)).alias("_d"))
                   .agg(m.cast("bigint").alias("_v")))
    per = daily.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_d", "_v")))
                                   .alias("_m"), F.min("_d").alias("_first"))
    n = F.dayofmonth(end)
    arr = F.transform(F.sequence(F.lit(1), n),
                      lambda d: F.coalesce(F.col("_m")[d], F.lit(fill).cast("bigint")))
    return per.select(*keys, month.alias("month_start"), arr.alias(name),
                      F.make_date(F.year(end), F.month(end), F.col("_first")).alias("first_found_date"))


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ON CONFLICT DO UPDATE as a new version: target rows whose key is
    not in ``new`` plus all of ``new``."""
    return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ON CONFLICT DO NOTHING: target plus rows of ``new`` with new keys."""
    return target.unionByName(new.join(target.select(*keys), list(keys), "left_anti"))


def daily_totals(df: DataFrame, name: str = "metric_array",
                 group: Sequence[str] = ()) -> DataFrame:
    """Sum the arrays by position -> one row per (group..., date).
    ``posexplode`` then a hash aggregate with partial aggregation, so the
    per-position sums are pre-reduced on the map side."""
    x = df.select(*group, "month_start", F.posexplode(name).alias("_pos", "_v"))
    return (x.groupBy(*group, "month_start", "_pos")
             .agg(F.sum(F.coalesce("_v", F.lit(0))).cast("bigint").alias("total"))
             .select(*group, F.date_add("month_start", F.col("_pos")).alias("date"), "total"))


def positional_sums(df: DataFrame, name: str, n: int, labels: Sequence[str],
                    group: Sequence[str] = ("month_start",)) -> DataFrame:
    """A12 (fixed positions): ``sum(coalesce(arr[i], 0))`` for i < n; ``get``
    is null-safe where ``arr[i]`` would raise under ANSI."""
    return df.groupBy(*group).agg(*[
        F.sum(F.coalesce(F.get(F.col(name), i), F.lit(0))).cast("bigint").alias(labels[i])
        for i in range(n)])


def _host_daily(events: DataFrame, lo, hi, host: str, user: str, ts: str) -> DataFrame:
    """Hits and distinct visitors per (host, day) in one aggregation."""
    e = events.where(F.col(user).isNotNull() & F.col(host).isNotNull()
                     & (F.col(ts) >= lo.cast("timestamp_ntz")) & (F.col(ts) < hi.cast("timestamp_ntz")))
    return (e.groupBy(host, F.dayofmonth(F.col(ts)).alias("_d"))
             .agg(F.count(F.lit(1)).alias("_h"), F.count_distinct(F.col(user)).alias("_u")))


def host_reduced_month(events: DataFrame, end_ds, host: str = "host", user: str = "user_id",
                       ts: str = "event_time") -> DataFrame:
    """D22 backfill form: per (month_start, host) two NULL-padded day arrays,
    hits (events) and unique visitors (distinct users), user and host not
    NULL.  One scan and one (host, day) aggregate feed both arrays; each
    array is assembled from at most 31 entries per host."""
    end = as_date(end_ds)
    month = F.trunc(end, "month")
    daily = _host_daily(events, month, F.date_add(end, 1), host, user, ts)
    per = daily.groupBy(host).agg(
        F.map_from_entries(F.collect_list(F.struct("_d", "_h"))).alias("_mh"),
        F.map_from_entries(F.collect_list(F.struct("_d", "_u"))).alias("_mu"),
        F.min("_d").alias("_first"))
    days = F.sequence(F.lit(1), F.dayofmonth(end))
    return per.select(host, month.alias("month_start"),
                      F.transform(days, lambda d: F.col("_mh")[d]).alias("hit_array"),
                      F.transform(days, lambda d: F.col("_mu")[d]).alias("unique_visitors_array"),
                      F.make_date(F.year(end), F.month(end), F.col("_first")).alias("first_found_date"))


def host_reduced_step(prev: DataFrame | None, events: DataFrame, ds, host: str = "host",
                      user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """D22 daily step: today's hits and visitors (one aggregate) set at the
    day-of-month position of both arrays; hosts absent today get NULL."""
    day = as_date(ds)
    month = F.trunc(day, "month")
    dom = F.dayofmonth(day)
    t = _host_daily(events, day, F.date_add(day, 1), host, user, ts).drop("_d")
    if prev is None:
        y = t.sparkSession.createDataFrame([], t.select(host).schema) \
             .withColumn("hit_array", F.array().cast("array<bigint>")) \
             .withColumn("unique_visitors_array", F.array().cast("array<bigint>")) \
             .withColumn("first_found_date", F.lit(None).cast("date"))
    else:
        y = prev.where(F.col("month_start") == month).select(
            host, "hit_array", "unique_visitors_array", "first_found_date")
    j = t.join(y, host, "full")
    return j.select(host, month.alias("month_start"),
                    _pad_and_set(F.col("hit_array"), dom, F.col("_h").cast("bigint"), None)
                    .alias("hit_array"),
                    _pad_and_set(F.col("unique_visitors_array"), dom, F.col("_u").cast("bigint"), None)
                    .alias("unique_visitors_array"),
                    F.least(F.col("first_found_date"), F.when(F.col("_h").isNotNull(), day))
                    .alias("first_found_date"))


def host_reduced_report(df: DataFrame, host: str = "host") -> DataFrame:
    """Per host-month: days covered, latest day's values, month totals,
    peak day -- all higher-order functions on the row's own arrays."""
    h, u = F.col("hit_array"), F.col("unique_visitors_array")
    nz = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x, F.lit(0)))
    return df.select(host, "month_start", F.size(h).cast("bigint").alias("days"),
                     F.element_at(h, -1).alias("latest_hits"),
                     F.element_at(u, -1).alias("latest_unique_visitors"),
                     nz(h).alias("month_hits"), nz(u).alias("month_visitor_days"),
                     F.array_max(h).alias("peak_day_hits"))


def array_consistency(df: DataFrame, a: str = "hit_array",
                      b: str = "unique_visitors_array") -> DataFrame:
    """Both lengths (NULL for a NULL array) and a status, 'OK' or
    'MISMATCH' where an array is NULL or the lengths differ."""
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")
    same = F.coalesce(size(a) == size(b), F.lit(False))
    return df.select("*", size(a).alias(f"{a}_length"), size(b).alias(f"{b}_length"),
                     F.when(same, "OK").otherwise("MISMATCH").alias("status"))
