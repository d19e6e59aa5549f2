"""Property graph as two tables: vertices(identifier, type, properties) and
edges(subject_identifier, subject_type, object_identifier, object_type,
edge_type, properties) (D10-D13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions.columns import properties_map
from strata.operators.relational import dedupe, parts_for

# The vertex and edge type enumerations.
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def team_vertices(teams: DataFrame) -> DataFrame:
    """One vertex per team.  Duplicate team rows are resolved by a total
    order, all columns descending (deterministic, unlike an unordered pick)."""
    cols = ["abbreviation", "nickname", "city", "arena", "yearfounded"]
    one = dedupe(teams, ["team_id"], order=cols, descending=True)
    return one.select(
        F.col("team_id").alias("identifier"), F.lit("team").alias("type"),
        properties_map([("abbreviation", "abbreviation"), ("nickname", "nickname"),
                        ("city", "city"), ("arena", "arena"),
                        ("year_founded", "yearfounded")]).alias("properties"))


def dedupe_details(details: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per (player, game): the first by team, then all other columns.

    The pick sorts its rows (a struct with names is no hash aggregate's buffer), so
    they are dealt out by key first, in as many parts as they need: a task sorts a
    part, neither a file split nor a fixed share of all rows.  Only copies of one
    key stay together; many of them spill."""
    keys = ["player_id", "game_id"]
    d = details.select(*keys, *[c for c in details.columns if c not in keys])
    return dedupe(d.repartition(parts or parts_for(d), *keys), keys, order=["team_id"]).select(*details.columns)


def _keyed():
    return F.col("player_id").isNotNull() & F.col("game_id").isNotNull()


def _details_apart(details: DataFrame) -> DataFrame:
    """``dedupe_details``, rows with both keys apart from the others: the edges
    that join on the keys need the former only, and all edges share one shuffle."""
    return dedupe_details(details.where(_keyed())).unionByName(dedupe_details(details.where(~_keyed())))


def player_game_edges(details: DataFrame) -> DataFrame:
    """``plays_in`` edges player -> game with a property map."""
    d = _details_apart(details)
    return d.select(
        F.col("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        properties_map([("start_position", "start_position_no"), ("pts", "pts"),
                        ("team_id", "team_id"),
                        ("team_abbreviation", "team_abbreviation")]).alias("properties"))


def player_player_edges(details: DataFrame) -> DataFrame:
    """``shares_team`` / ``plays_against`` edges between two players of
    one game, with the number of games and each side's points.

    The pairs are the result itself, so they are produced by an equi self-join
    on game_id (after the per-(player, game) dedupe, so duplicates never
    multiply) with ``a.player_id > b.player_id``.  The join is a sort-merge join
    on game_id; if one game were hot, AQE's skew handling splits that game's
    partition on both sides of the inner join, so its pairs are spread over
    many tasks; the pair aggregate then has a map-side partial step.
    """
    d = dedupe_details(details.where(_keyed())).select("game_id", "player_id", "player_name",
                                                       "team_abbreviation", "pts")
    a, b = d.alias("a"), d.alias("b")
    j = a.join(b, (F.col("a.game_id") == F.col("b.game_id"))
                  & (F.col("a.player_id") > F.col("b.player_id"))
                  & (F.col("a.player_name") != F.col("b.player_name")))
    et = F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"),
                F.lit("shares_team")).otherwise(F.lit("plays_against"))
    return (j.groupBy(F.col("a.player_id").alias("subject_player_id"),
                      F.col("a.player_name").alias("subject_player_name"),
                      F.col("b.player_id").alias("object_player_id"),
                      F.col("b.player_name").alias("object_player_name"),
                      et.alias("edge_type"))
             .agg(F.count(F.lit(1)).alias("num_games"),
                  F.sum("a.pts").alias("subject_points"),
                  F.sum("b.pts").alias("object_points")))


def player_vertices(details: DataFrame) -> DataFrame:
    d = dedupe_details(details)
    agg = d.groupBy("player_id").agg(F.max("player_name").alias("player_name"),
                                     F.count(F.lit(1)).alias("number_of_games"),
                                     F.sum("pts").alias("total_points"),
                                     F.count_distinct("team_id").alias("num_teams"))
    return agg.select(F.col("player_id").alias("identifier"), F.lit("player").alias("type"),
                      properties_map([("player_name", "player_name"),
                                      ("number_of_games", "number_of_games"),
                                      ("total_points", "total_points"),
                                      ("num_teams", "num_teams")]).alias("properties"))


def game_vertices(games: DataFrame) -> DataFrame:
    return games.select(F.col("game_id").alias("identifier"), F.lit("game").alias("type"),
                        properties_map([("season", "season"),
                                        ("home_team_id", "home_team_id"),
                                        ("visitor_team_id", "visitor_team_id"),
                                        ("home_team_wins", "home_team_wins")]).alias("properties"))


def player_team_edges(details: DataFrame) -> DataFrame:
    """``plays_on`` edges player -> team with the games played for it."""
    d = _details_apart(details)
    agg = d.groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("num_games"),
                                                F.sum("pts").alias("pts"))
    return agg.select(
        F.col("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("team_id").alias("object_identifier"), F.lit("team").alias("object_type"),
        F.lit("plays_on").alias("edge_type"),
        properties_map([("num_games", "num_games"), ("pts", "pts")]).alias("properties"))


def check_enum(df: DataFrame, column: str, allowed) -> DataFrame:
    """Enum check: rows with a value outside ``allowed`` raise at runtime."""
    ok = F.col(column).isin(*allowed)
    return df.withColumn(column, F.when(ok, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {column}: "), F.col(column).cast("string")))))


def graph_union(details: DataFrame, teams: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assemble the typed vertex and edge tables (identifiers as text)."""
    v = (player_vertices(details).unionByName(team_vertices(teams))
         .unionByName(game_vertices(games)))
    v = check_enum(v.withColumn("identifier", F.col("identifier").cast("string")), "type", VERTEX_TYPES)
    pp = player_player_edges(details).select(
        F.col("subject_player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("object_player_id").alias("object_identifier"), F.lit("player").alias("object_type"),
        "edge_type",
        properties_map([("num_games", "num_games"), ("subject_points", "subject_points"),
                        ("object_points", "object_points")]).alias("properties"))
    e = player_game_edges(details).unionByName(pp).unionByName(player_team_edges(details))
    e = (e.withColumn("subject_identifier", F.col("subject_identifier").cast("string"))
          .withColumn("object_identifier", F.col("object_identifier").cast("string")))
    return v, check_enum(e, "edge_type", EDGE_TYPES)
