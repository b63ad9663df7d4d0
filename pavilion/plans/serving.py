"""Read queries over the Gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pavilion.config import RANKING_LIMIT, RANKING_LIMIT_MAX
from pavilion.functions.text import contains_text, same_text
from pavilion.operators.rank import page, ranked_page, top_ranked, write_ranked
from pavilion.plans.marts import best_first


def _rankings(mart: DataFrame, metric: str, limit: int) -> DataFrame:
    if not 1 <= limit <= RANKING_LIMIT_MAX:
        raise ValueError(f"limit must lie in 1..{RANKING_LIMIT_MAX}")
    top = top_ranked(mart, *best_first(), limit=limit)
    return top.select(
        "rank", "player", "country_tag", "pca_score", "matches", F.col(metric).alias("primary_metric")
    )


def rankings_batsmen(mart: DataFrame, limit: int = RANKING_LIMIT) -> DataFrame:
    """Best batsmen; works on the mart or on its rows without rank."""
    return _rankings(mart.drop("rank"), "runs", limit)


def rankings_bowlers(mart: DataFrame, limit: int = RANKING_LIMIT) -> DataFrame:
    return _rankings(mart.drop("rank"), "wickets", limit)


_PLAYER_COLUMNS = (
    "player",
    "country_tag",
    "matches",
    "innings",
    "runs",
    "wickets",
    "pca_score",
)


def player_stats(dim: DataFrame, player: str) -> DataFrame:
    """Career rows of one player, whatever the letter case."""
    return dim.where(same_text(F.col("player"), player)).select(*_PLAYER_COLUMNS)


def _player_order() -> list[Column]:
    return [F.col("player").asc_nulls_last(), F.col("career_start_year").asc_nulls_last()]


def players_page(dim: DataFrame, limit: int, offset: int) -> DataFrame:
    """One page of the player dimension, with the total number of players; sorts it for this page."""
    return page(dim, _player_order(), limit, offset).select("total", *_PLAYER_COLUMNS)


def write_players(dim: DataFrame, path: str) -> None:
    """The player dimension in page order with its rank directory, for ``read_players``."""
    write_ranked(dim, _player_order(), path)


def read_players(spark: SparkSession, path: str, limit: int, offset: int) -> DataFrame:
    """One page of what ``write_players`` wrote, from the files that hold it."""
    return ranked_page(spark, path, limit, offset).select("rank", "total", *_PLAYER_COLUMNS)


def player_context(
    fact: DataFrame,
    players: DataFrame,
    weather: DataFrame,
    name_part: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """Average runs per ball in rain and in heat, and balls faced, per batter.

    The balls are first summed per batter and weather, before any join, so a
    batter with a third of all balls arrives at the joins as a few rows.
    """
    sums = fact.groupBy("batter_id", "weather_id").agg(
        F.sum("runs_batter").alias("runs"),
        F.count("runs_batter").alias("scored"),
        F.count("match_id").alias("balls"),
    )
    if name_part is not None:
        players = players.where(contains_text(F.col("player_name"), name_part, literal))
    bands = weather.select("weather_id", "weather_condition").distinct()
    rows = sums.join(players, F.col("batter_id") == F.col("player_id")).join(
        bands, "weather_id", "left"
    )

    def average_in(band: str):
        here = F.col("weather_condition") == band
        total = F.sum(F.when(here, F.col("runs"))).cast("double")
        return total / F.nullif(F.sum(F.when(here, F.col("scored"))), F.lit(0))

    return rows.groupBy(F.col("player_name").alias("player")).agg(
        average_in("Rainy").alias("avg_runs_in_rain"),
        average_in("Hot").alias("avg_runs_in_hot"),
        F.sum("balls").alias("total_balls_faced"),
    )


def mart_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """(mart, n_rows) of stored marts, by name; an empty one counts 0."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("mart"), "n_rows") for name, df in marts.items()]
    return reduce(DataFrame.unionByName, counts)
