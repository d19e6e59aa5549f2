"""Batch jobs of the Spark module: gaming report, player ranking, monthly user
activity, device lists, business metrics (D37-D40, D43)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strata.functions.columns import SKILL_TIERS, tier
from strata.operators.relational import global_rank, top_k


def top1(df: DataFrame, question: str, name_col: str, value_col: str) -> DataFrame:
    """The best row by ``value_col`` (ties by name), as (question, answer, value)."""
    t = top_k(df, [F.desc(value_col), F.asc(name_col)], 1)
    return t.select(F.lit(question).alias("question"), F.col(name_col).cast("string").alias("answer"),
                    F.col(value_col).cast("double").alias("value"))


def match_report(details: DataFrame, matches: DataFrame, mmp: DataFrame, medals: DataFrame,
                 maps: DataFrame, medal_name: str = "Killing Spree",
                 medal_match: str = "equals") -> DataFrame:
    """Four answers -- player with the highest average kills per game,
    most played playlist, most played map, map with the most medals of one
    kind.  Each answer aggregates its own facts (so kills and match counts are
    not weighted by a medal fan-out).  The joins are plain equi joins: AQE
    broadcasts the map and medal sides where their measured bytes are few."""
    kills = (details.where(F.col("player_total_kills").isNotNull())
                    .groupBy("player_gamertag")
                    .agg(F.avg("player_total_kills").alias("avg_kills")))
    playlists = matches.groupBy("playlist_id").agg(F.count_distinct("match_id").alias("n"))
    m_maps = matches.join(maps, "mapid")
    maps_played = (m_maps.where(F.col("name").isNotNull())
                         .groupBy("name").agg(F.count_distinct("match_id").alias("n")))
    md = medals.withColumnRenamed("name", "medal_name")
    cond = (F.col("medal_name") == medal_name) if medal_match == "equals" \
        else F.col("medal_name").contains(medal_name)
    sel = mmp.join(md.where(cond), "medal_id")
    spree = (sel.join(m_maps.select("match_id", "name"), "match_id")
                .where(F.col("name").isNotNull())
                .groupBy("name").agg(F.sum("count").alias("n")))
    return (top1(kills, "top_killer", "player_gamertag", "avg_kills")
            .unionByName(top1(playlists, "top_playlist", "playlist_id", "n"))
            .unionByName(top1(maps_played, "top_map", "name", "n"))
            .unionByName(top1(spree, "top_medal_map", "name", "n")))


def player_ranking(details: DataFrame, min_games: int = 5) -> DataFrame:
    """Average kills/deaths per player (kills not NULL, at least
    ``min_games`` games), global rank by average kills, skill tier."""
    g = (details.where(F.col("player_total_kills").isNotNull())
                .groupBy("player_gamertag")
                .agg(F.avg("player_total_kills").alias("avg_kills"),
                     F.avg("player_total_deaths").alias("avg_deaths"),
                     F.count(F.lit(1)).alias("games_played"))
                .where(F.col("games_played") >= min_games))
    g = g.withColumn("skill_tier", tier("avg_kills", SKILL_TIERS, "Beginner"))
    return global_rank(g, [("avg_kills", "desc")], name="kill_rank")


def user_activity_monthly(events: DataFrame, homepage: str = "/") -> DataFrame:
    """Per user-month events, distinct hosts and the homepage share."""
    return (events.where(F.col("user_id").isNotNull())
                  .groupBy("user_id", F.trunc(F.to_date("event_time"), "month").alias("month_start"))
                  .agg(F.count(F.lit(1)).alias("total_events"),
                       F.count_distinct("host").alias("unique_hosts"),
                       F.avg(F.when(F.col("url") == homepage, 1.0).otherwise(0.0))
                       .alias("homepage_ratio")))


def events_per_user_device(events: DataFrame) -> DataFrame:
    """A17 first phase: events per (user, device) with their distinct hosts;
    reused by both reports below (Spark reuses the exchange, or the caller
    persists it)."""
    return (events.groupBy("user_id", "device_id")
                  .agg(F.count(F.lit(1)).alias("event_counts"),
                       F.array_sort(F.collect_set("host")).alias("host_array")))


def users_and_devices(agg: DataFrame, users: DataFrame) -> DataFrame:
    """Per user, the largest per-device event count and the devices.
    The device list per user is bounded by the user's own devices."""
    return (users.join(agg, "user_id")
                 .groupBy("user_id")
                 .agg(F.max("event_counts").alias("total_hits"),
                      F.array_sort(F.collect_list("device_id")).alias("devices")))


def user_device_rows(agg: DataFrame) -> DataFrame:
    """D40a in rows: per (user, device) its events, the user's largest event count
    and number of devices; nothing is collected per user."""
    users = agg.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"), F.count(F.lit(1)).alias("num_devices"))
    return agg.select("user_id", "device_id", "event_counts").join(users, "user_id")


def devices_on_events(agg: DataFrame, devices: DataFrame) -> DataFrame:
    """Per device, its users with the hosts they visited.  One device can
    be shared by a very large share of users, so the users are returned as
    (device, user) rows plus a count per device rather than one unbounded array
    per device."""
    j = devices.select("device_id", "device_type").join(agg, "device_id")
    cnt = j.groupBy("device_id", "device_type").agg(F.count_distinct("user_id").alias("num_users"))
    return j.select("device_id", "device_type", "user_id", "host_array").join(cnt, ["device_id", "device_type"])


def business_metrics(orders: DataFrame) -> DataFrame:
    """Daily profit (revenue), growth (day-over-day change, new
    customers) and engagement (orders per active customer) series.  The
    window runs over the daily table -- one row per day, bounded by the
    calendar."""
    o = orders.select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    first = o.groupBy("o_custkey").agg(F.min("day").alias("day")) \
             .groupBy("day").agg(F.count(F.lit(1)).alias("new_customers"))
    d = (o.groupBy("day").agg(F.sum("o_totalprice").alias("revenue"),
                               F.count(F.lit(1)).alias("num_orders"),
                               F.count_distinct("o_custkey").alias("active_customers"))
          .join(first, "day", "left")
          .withColumn("new_customers", F.coalesce("new_customers", F.lit(0)).cast("bigint")))
    w = Window.orderBy("day")
    return d.select("day", "revenue", "num_orders", "active_customers", "new_customers",
                    (F.col("revenue") - F.lag("revenue").over(w)).alias("revenue_change"),
                    F.sum("new_customers").over(w.rowsBetween(Window.unboundedPreceding, 0))
                    .alias("cumulative_customers"),
                    (F.col("num_orders") / F.col("active_customers")).alias("orders_per_customer"))
