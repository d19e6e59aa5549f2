"""Game-detail analyses of the analytical-patterns homework."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strata.operators.graph import dedupe_details
from strata.operators.relational import keyed_sequence, parts_for


def team_games(details: DataFrame, games: DataFrame) -> DataFrame:
    """One row per (team, game) with the game date and whether the team won
    (home team and home win, or visitor and home loss)."""
    d = dedupe_details(details).select("game_id", "team_id").distinct()
    g = games.select("game_id", "game_date_est", "season", "home_team_id", "visitor_team_id",
                     "home_team_wins")
    won = (((F.col("team_id") == F.col("home_team_id")) & F.col("home_team_wins"))
           | ((F.col("team_id") == F.col("visitor_team_id")) & ~F.col("home_team_wins")))
    return d.join(g, "game_id").select("team_id", "game_id", "game_date_est", "season",
                                       won.alias("won"))


def game_grouping_sets(details: DataFrame, games: DataFrame) -> DataFrame:
    """Points by (player, team), (player, season) and (team) in one
    aggregation; games won counted once per (team, game).

    The details join the games once, and the grouping sets expand sums per
    (player, team, season), not games.  Their rows are dealt out in as many parts as
    the details need, so these tasks do not grow with the input; the sets' last sums
    take the session's shuffle partitions.  A game has one row per player when it is
    joined, so none outgrows the players."""
    n = parts_for(details)
    d = (dedupe_details(details, n).select("game_id", "team_id", "player_id", "pts")
         .where(F.col("team_id").isNotNull()).repartition(n, "game_id"))
    # one representative row per (team, game) -- its lowest player -- lets the
    # team set count each won game once without a DISTINCT aggregate; a player
    # has one row per game, so the player sets count won games with a plain sum
    first = F.row_number().over(Window.partitionBy("game_id", "team_id").orderBy(F.col("player_id").asc_nulls_last()))
    d = d.withColumn("_rep", (first == 1) & F.col("player_id").isNotNull())
    won = (((F.col("team_id") == F.col("home_team_id")) & F.col("home_team_wins"))
           | ((F.col("team_id") == F.col("visitor_team_id")) & ~F.col("home_team_wins")))
    played = (d.join(games.repartition(n, "game_id"), "game_id")
              .select("player_id", "team_id", "season", "pts", "_rep", won.cast("int").alias("_won")))
    fine = played.repartition(n, "player_id", "team_id", "season").groupBy("player_id", "team_id", "season").agg(
        F.sum("pts").alias("_pts"), F.sum("_won").alias("_won"),
        F.sum(F.when(F.col("_rep"), F.col("_won")).otherwise(0)).alias("_team_won"))
    g = fine.groupingSets([["player_id", "team_id"], ["player_id", "season"], ["team_id"]],
                          "player_id", "team_id", "season").agg(
        F.sum("_pts").alias("total_points"),
        F.sum("_won").alias("_won_rows"),
        F.sum("_team_won").alias("_won_games"),
        F.grouping_id("player_id", "team_id", "season").alias("_gid"))
    level = (F.when(F.col("_gid") == 1, "player_team").when(F.col("_gid") == 2, "player_season")
              .otherwise("team"))
    games_won = F.when(F.col("_gid") == 5, F.col("_won_games")).otherwise(F.col("_won_rows"))
    return g.select(level.alias("aggregation_level"), "player_id", "team_id", "season",
                    "total_points", games_won.cast("bigint").alias("games_won"))


def most_wins_in_stretch(details: DataFrame, games: DataFrame, n: int = 90) -> DataFrame:
    """Per team, the most wins in any ``n`` consecutive games (the ROWS
    ``n-1`` PRECEDING frame, partial at the start).

    Wins in the stretch ending at game s = C(s) - C(s - n), with C the running
    win count in game order.  C and s come from ``keyed_sequence`` (spread
    over tasks even for a team with a huge schedule) and C(s - n) is an equi
    join on (team, s - n) -- no window holds a whole team."""
    tg = team_games(details, games).withColumn("_w", F.col("won").cast("bigint"))
    c = keyed_sequence(tg, ["team_id"], [F.col("game_date_est"), F.col("game_id")], "_s",
                       running="_w").select("team_id", "_s", F.col("_w_cum").alias("_c"))
    back = c.select("team_id", (F.col("_s") + n).alias("_s"), F.col("_c").alias("_c_back"))
    x = c.join(back, ["team_id", "_s"], "left")
    stretch = F.col("_c") - F.coalesce("_c_back", F.lit(0))
    return x.groupBy("team_id").agg(F.max(stretch).cast("bigint").alias(f"max_wins_in_{n}"),
                                    F.count(F.lit(1)).alias("games"))


def longest_scoring_run(details: DataFrame, games: DataFrame, min_pts: int = 10) -> DataFrame:
    """Per player, the most consecutive games (by date) scoring more
    than ``min_pts`` (islands by difference of row numbers)."""
    d = dedupe_details(details).join(games.select("game_id", "game_date_est"), "game_id")
    order = [F.col("game_date_est"), F.col("game_id")]
    x = d.select("player_id", "game_id", "game_date_est", (F.col("pts") > min_pts).cast("bigint").alias("_hit"))
    # the position among the player's hit games is the running count of hits
    # in the same order, so one keyed sequence gives both row numbers
    x = keyed_sequence(x, ["player_id"], order, "_s_all", running="_hit")
    x = x.withColumn("_grp", F.col("_s_all") - F.col("_hit_cum"))
    runs = x.where(F.col("_hit") == 1).groupBy("player_id", "_grp").agg(F.count(F.lit(1)).alias("_len"))
    return runs.groupBy("player_id").agg(F.max("_len").alias("longest_run"))
