"""Windowed stream aggregations (T2-T4, T9).  Every function works on a
streaming or a static DataFrame alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def tumbling_hits(df: DataFrame, width: str = "5 minutes", keys: Sequence[str] = ("host",),
                  ts: str = "event_timestamp", counted: str = "host") -> DataFrame:
    """Non-NULL ``counted`` per tumbling window and keys.  The output
    column keeps the source name ``event_hour`` although it holds the window
    start (Q15).  Map-side partial aggregation; state is one row per open
    (window, keys)."""
    g = df.groupBy(F.window(F.col(ts), width).alias("w"), *keys)
    return g.agg(F.count(F.col(counted)).alias("num_hits")).select(
        F.col("w.start").alias("event_hour"), *keys, "num_hits")


def sessionize(df: DataFrame, gap: str = "5 minutes", keys: Sequence[str] = ("ip", "host"),
               ts: str = "event_timestamp") -> DataFrame:
    """T4: sessions per keys: events at most ``gap`` apart merge; session_end =
    last event + gap.  Events without a time belong to none.

    A stream uses ``session_window``.  A bounded table is first counted per (keys,
    time slot of one gap): all events of a slot are in one session, so a hot key's
    events are merged map side and spread over tasks by slot.  Slots become
    sessions by comparing neighbours; a key has at most (time span / gap) slots,
    however many events."""
    if df.isStreaming:
        g = df.groupBy(F.session_window(F.col(ts), gap).alias("s"), *keys)
        return g.agg(F.count(F.lit(1)).alias("num_events")).select(
            F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
            *keys, "num_events")
    length = F.expr(f"INTERVAL {gap}")
    micros = F.unix_micros(F.timestamp_micros(F.lit(0)) + length)
    slot = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / micros)
    slots = df.where(F.col(ts).isNotNull()).groupBy(*keys, slot.alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_slot")
    before = F.lag("_last").over(w)
    slots = slots.withColumn("_new", F.when(before.isNull() | (F.col("_first") > before + length), 1).otherwise(0))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (slots.withColumn("_id", F.sum("_new").over(upto)).groupBy(*keys, "_id")
            .agg(F.min("_first").alias("session_start"), (F.max("_last") + length).alias("session_end"),
                 F.sum("_n").alias("num_events"))
            .select("session_start", "session_end", *keys, "num_events"))


def session_summary(sessions: DataFrame, host_pattern: str = "%.example",
                    named_hosts: Sequence[str] = (), min_sessions: int = 2) -> DataFrame:
    """The session reports as one long table (report, key, value).

    Overall: number of sessions; sessions, events and events per session of all
    hosts LIKE the pattern together; first and last session start (microseconds).
    Per host: sessions; for the named hosts and for hosts with at least
    ``min_sessions`` sessions also their events per session.  Averages are
    rounded to two decimals.  Sessions are read once: a rollup of per-host sums
    gives both grains."""
    like = F.col("host").like(host_pattern)
    hosts = sessions.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("num_events").alias("events"),
        F.min("session_start").alias("first"), F.max("session_start").alias("last"))
    both = hosts.rollup("host").agg(
        F.grouping("host").alias("overall"), F.sum("n").alias("n"), F.sum("events").alias("events"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum(F.when(like, F.col("n"))).alias("like_n"), F.sum(F.when(like, F.col("events"))).alias("like_events"))
    mean = lambda events, n: F.round(F.col(events) / F.col(n), 2)
    report = lambda name, value, shown: F.when(
        shown, F.struct(F.lit(name).alias("report"), F.col("host").alias("key"), value.cast("double").alias("value")))
    overall = F.col("overall") == 1
    host = ~overall
    named, busy = host & F.col("host").isin(*named_hosts), host & (F.col("n") >= min_sessions)
    reports = F.array(
        report("total_sessions", F.col("n"), overall),
        report("pattern_sessions", F.coalesce("like_n", F.lit(0)), overall),
        report("pattern_events", F.coalesce("like_events", F.lit(0)), overall),
        report("pattern_avg_events", mean("like_events", "like_n"), overall),
        report("first_session_start", F.unix_micros("first"), overall),
        report("last_session_start", F.unix_micros("last"), overall),
        report("sessions_per_host", F.col("n"), host),
        report("named_host_sessions", F.col("n"), named),
        report("named_host_avg_events", mean("events", "n"), named),
        report("busy_host_sessions", F.col("n"), busy),
        report("busy_host_avg_events", mean("events", "n"), busy))
    return both.select(F.inline(F.filter(reports, lambda r: r.isNotNull())))
