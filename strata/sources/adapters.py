"""Domain tables derived from the driver's star-schema tables.

The operators work on the domain schemas of the analytics patterns (web
events, devices, player seasons, actor films, game details, teams, match
tables).  These adapters derive them from the driver tables with plain
projections, joins and aggregations, so every query's work grows with the
input.  The SQL oracle rebuilds the same tables (``strata.plans.oracle_views``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.sources.readers import Tables

# Fixed values of the synthetic mapping (chosen here, shared with the oracle).
REFERRERS = {           # props.k % 7  -> referrer URL (5 -> NULL)
    0: "https://www.google.com/search",
    1: "https://t.co/x1",
    2: "https://www.linkedin.com/feed",
    3: "https://lnkd.in/post",
    4: "https://blog.strata.example/home",
    6: "https://news.example.org/",
}
ON_SITE_PATTERNS = ("%blog.strata.example%", "%www.strata.example%")
MEDAL_NAMES = ["Killing Spree", "Double Kill", "Triple Kill", "Headshot",
               "Killing Spree Extended", "Sniper Kill", "First Strike",
               "Perfection", "Overkill", "Distraction"]


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def web_events(t: Tables) -> DataFrame:
    """events(url, referrer, user_id, device_id, host, event_time, event_type, value)."""
    e = t.events
    k = _k(e.props)
    ref = F.lit(None).cast("string")
    for m in sorted(REFERRERS, reverse=True):
        ref = F.when(k % 7 == m, F.lit(REFERRERS[m])).otherwise(ref)
    return e.select(
        F.when(e.event_type == "view", F.lit("/"))
         .otherwise(F.concat(F.lit("/"), e.event_type)).alias("url"),
        ref.alias("referrer"),
        F.when(k % 20 == 0, F.lit(None).cast("bigint"))
         .otherwise(e.user_id).alias("user_id"),
        e.user_id.alias("device_id"),
        F.concat(F.lit("h"), _s(k % 5), F.lit(".example")).alias("host"),
        e.ts.alias("event_time"),
        e.event_type,
        e.value,
    )


def devices(t: Tables) -> DataFrame:
    """devices(device_id, browser_type, browser_version_major, os_type, device_type)."""
    c, n, r = t.customer, t.nation, t.region
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(c.c_custkey.alias("device_id"),
                     c.c_mktsegment.alias("browser_type"),
                     c.c_nationkey.cast("bigint").alias("browser_version_major"),
                     n.n_name.alias("os_type"),
                     r.r_name.alias("device_type")))


def player_seasons(t: Tables) -> DataFrame:
    """player_seasons: one row per (customer, order year)."""
    o = t.orders
    ck = o.o_custkey
    return (o.groupBy(ck, F.year(o.o_orderdate).cast("bigint").alias("season"))
             .agg(F.count(F.lit(1)).alias("gp"),
                  # exact: integer cents summed, then divided (no float-order drift)
                  (F.sum(F.round(o.o_totalprice * 100).cast("bigint")).cast("double")
                   / F.count(F.lit(1)) / 1500000.0).alias("pts"),
                  (F.min(o.o_totalprice) / 20000.0).alias("reb"),
                  (F.max(o.o_totalprice) / 40000.0).alias("ast"))
             .select(F.concat(F.lit("player_"), _s(ck)).alias("player_name"),
                     F.concat(_s(5 + ck % 3), F.lit("-"), _s(ck % 12)).alias("height"),
                     (150 + ck % 100).alias("weight"),
                     F.concat(F.lit("college_"), _s(ck % 40)).alias("college"),
                     F.concat(F.lit("country_"), _s(ck % 12)).alias("country"),
                     _s(1990 + ck % 15).alias("draft_year"),
                     _s(1 + ck % 2).alias("draft_round"),
                     _s(1 + ck % 60).alias("draft_number"),
                     "season", "gp", "pts", "reb", "ast"))


def actor_films(t: Tables) -> DataFrame:
    """actor_films(actor, actorid, film, filmid, year, votes, rating)."""
    l, o = t.lineitem, t.orders
    film = F.concat(F.lit("film_"), _s(l.l_orderkey), F.lit("_"), _s(l.l_partkey),
                    F.lit("_"), _s(l.l_suppkey))
    return (l.join(o, l.l_orderkey == o.o_orderkey)
             .select(F.concat(F.lit("actor_"), _s(o.o_custkey)).alias("actor"),
                     o.o_custkey.alias("actorid"),
                     film.alias("film"),
                     film.alias("filmid"),
                     F.year(o.o_orderdate).cast("bigint").alias("year"),
                     l.l_quantity.cast("bigint").alias("votes"),
                     (F.floor(l.l_extendedprice % 1000).cast("double") / 100.0)
                     .alias("rating")))


def game_details(t: Tables) -> DataFrame:
    """game_details; the l_linenumber = 1 rows appear twice (exact duplicates),
    as the source table has duplicate (game, team, player) rows."""
    l = t.lineitem
    base = l.select(
        l.l_orderkey.alias("game_id"),
        l.l_suppkey.alias("team_id"),
        F.concat(F.lit("T"), _s(l.l_suppkey)).alias("team_abbreviation"),
        l.l_partkey.alias("player_id"),
        F.concat(F.lit("player_"), _s(l.l_partkey)).alias("player_name"),
        l.l_linenumber.cast("bigint").alias("start_position_no"),
        l.l_quantity.cast("bigint").alias("pts"),
        (l.l_linenumber * 2).cast("bigint").alias("reb"),
        F.floor(l.l_discount * 100).cast("bigint").alias("ast"),
    )
    return base.unionByName(base.where(F.col("start_position_no") == 1))


def games(t: Tables) -> DataFrame:
    """games(game_id, game_date_est, season, home_team_id, visitor_team_id,
    home_team_wins): home/visitor are the lowest/highest team of the game."""
    l, o = t.lineitem, t.orders
    teams_of = l.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("home_team_id"),
                                           F.max("l_suppkey").alias("visitor_team_id"))
    return o.join(teams_of, o.o_orderkey == teams_of.l_orderkey).select(
        o.o_orderkey.alias("game_id"),
        F.to_date(o.o_orderdate).alias("game_date_est"),
        F.year(o.o_orderdate).cast("bigint").alias("season"),
        "home_team_id", "visitor_team_id",
        (o.o_orderkey % 3 != 0).alias("home_team_wins"))


def teams(t: Tables) -> DataFrame:
    """teams; suppliers with s_suppkey % 10 = 0 get a second row with another
    nickname (duplicate team rows, as in the vertex test)."""
    s, n = t.supplier, t.nation
    base = (s.join(n, s.s_nationkey == n.n_nationkey)
             .select(s.s_suppkey.alias("team_id"),
                     F.concat(F.lit("T"), _s(s.s_suppkey)).alias("abbreviation"),
                     s.s_name.alias("nickname"),
                     n.n_name.alias("city"),
                     F.concat(F.lit("arena_"), _s(s.s_nationkey)).alias("arena"),
                     (1900 + s.s_suppkey % 100).alias("yearfounded")))
    dup = (base.where(F.col("team_id") % 10 == 0)
               .withColumn("nickname", F.concat(F.lit("Alt "), F.col("nickname"))))
    return base.unionByName(dup)


def match_details(t: Tables) -> DataFrame:
    """match_details(match_id, player_gamertag, player_total_kills, player_total_deaths)."""
    l = t.lineitem
    return l.select(
        l.l_orderkey.alias("match_id"),
        F.concat(F.lit("gamer_"), _s(l.l_partkey % 300)).alias("player_gamertag"),
        F.when(l.l_linenumber == 7, F.lit(None).cast("bigint"))
         .otherwise(l.l_quantity.cast("bigint")).alias("player_total_kills"),
        (l.l_linenumber * 3 + l.l_partkey % 5).cast("bigint").alias("player_total_deaths"),
    )


def matches(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(o.o_orderkey.alias("match_id"),
                    F.concat(F.lit("map_"), _s(o.o_custkey % 25)).alias("mapid"),
                    o.o_orderpriority.alias("playlist_id"),
                    F.to_date(o.o_orderdate).alias("completion_date"))


def medals_matches_players(t: Tables) -> DataFrame:
    l = t.lineitem
    return (l.select(l.l_orderkey.alias("match_id"),
                     F.concat(F.lit("gamer_"), _s(l.l_partkey % 300)).alias("player_gamertag"),
                     (l.l_suppkey % 10).alias("medal_id"),
                     l.l_linenumber.cast("bigint").alias("count")))


def medals(t: Tables) -> DataFrame:
    p = t.part
    mid = p.p_partkey % 10
    name = F.element_at(F.array(*[F.lit(x) for x in MEDAL_NAMES]), (mid + 1).cast("int"))
    return p.select(mid.alias("medal_id"), name.alias("name")).distinct()


def maps(t: Tables) -> DataFrame:
    n = t.nation
    return n.select(F.concat(F.lit("map_"), _s(n.n_nationkey)).alias("mapid"),
                    n.n_name.alias("name"))


IP_BASE = 167772160   # 10.0.0.0


def web_events_ip(t: Tables) -> DataFrame:
    """Web events with a client IP: 10.x.y.z where x.y encode the device and z
    the event's props.k (so one device uses up to 256 addresses)."""
    e = t.events
    k = _k(e.props)
    dev = e.user_id
    ip = F.concat_ws(".", F.lit("10"), _s(F.floor(dev / 256) % 256), _s(dev % 256), _s(k % 256))
    return e.select(
        F.when(e.event_type == "view", F.lit("/"))
         .otherwise(F.concat(F.lit("/"), e.event_type)).alias("url"),
        F.concat(F.lit("h"), _s(k % 5), F.lit(".example")).alias("host"),
        ip.alias("ip"),
        e.ts.alias("event_time"))


def web_stream_events(t: Tables) -> DataFrame:
    """The web stream's message fields (all text, event time formatted as
    ``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'``) derived from the events table."""
    e = t.events
    k = _k(e.props)
    ref = F.lit(None).cast("string")
    for m in sorted(REFERRERS, reverse=True):
        ref = F.when(k % 7 == m, F.lit(REFERRERS[m])).otherwise(ref)
    return e.select(
        F.when(e.event_type == "view", F.lit("/"))
         .otherwise(F.concat(F.lit("/"), e.event_type)).alias("url"),
        ref.alias("referrer"),
        F.lit("strata-test-agent").alias("user_agent"),
        F.concat(F.lit("h"), _s(k % 5), F.lit(".example")).alias("host"),
        F.concat_ws(".", F.lit("10"), _s(F.floor(e.user_id / 256) % 256), _s(e.user_id % 256),
                    _s(k % 256)).alias("ip"),
        F.lit("{}").alias("headers"),
        F.date_format(e.ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"))


def ip_ranges(t: Tables) -> DataFrame:
    """ip_start, ip_end, country, state, city: one /24 block per customer."""
    c, n = t.customer, t.nation
    start = F.lit(IP_BASE) + c.c_custkey * 256
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(start.alias("ip_start"), (start + 255).alias("ip_end"),
                     n.n_name.alias("country"),
                     F.concat(F.lit("state_"), _s(c.c_custkey % 50)).alias("state"),
                     F.concat(F.lit("city_"), _s(c.c_custkey % 500)).alias("city")))
