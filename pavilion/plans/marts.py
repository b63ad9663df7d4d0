"""Gold tables: dimensions, facts and ranking marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.config import MartRule, RoleRule
from pavilion.functions.keys import reading_text, surrogate_key
from pavilion.functions.scores import (
    batting_score,
    bowling_score,
    headline_score,
    player_role,
    weather_band,
)
from pavilion.functions.text import clean_name
from pavilion.operators.columns import first_present
from pavilion.operators.joins import (
    full_outer_null_safe,
    hot_key_join,
    prefixed,
    salted_join,
)
from pavilion.operators.rank import global_rank
from pavilion.operators.reshape import distinct_values, unpivot_metrics

# Long-format metric names and their staging columns (fixed values).
BATTING_METRICS = {
    "matches": "matches",
    "runs": "runs",
    "batting_average": "average",
    "strike_rate": "strike_rate",
    "hundreds": "hundreds",
    "fifties": "fifties",
    "fours": "fours",
    "sixes": "sixes",
}
BOWLING_METRICS = {
    "wickets": "wickets",
    "bowling_average": "bowling_average",
    "economy_rate": "economy_rate",
    "bowling_strike_rate": "bowling_strike_rate",
}

_SHARED = ("country_tag", "career_end_year", "matches", "innings")


# ------------------------------------------------------------------- career stats


def joined_careers(
    batting: DataFrame, bowling: DataFrame, same_start: bool = True
) -> DataFrame:
    """Batting and bowling careers side by side; the batting side's shared values win.

    A player whose two careers start in different years gets two rows, unless
    ``same_start`` is off. Both staging tables hold one row per player, so no join
    key is hot.
    """
    year = ["career_start_year"]
    keys, shared = (year, _SHARED) if same_start else ([], (*year, *_SHARED))
    bat = batting.select(
        "player",
        *year,
        *_SHARED,
        "runs",
        F.col("average").alias("batting_average"),
        F.col("strike_rate").alias("batting_strike_rate"),
        "hundreds",
        "fifties",
        "fours",
        "sixes",
    )
    bowl = bowling.select(
        "player",
        *keys,
        *[F.col(c).alias(f"bowl_{c}") for c in shared],
        "wickets",
        "bowling_average",
        "economy_rate",
        "bowling_strike_rate",
    )
    joined = full_outer_null_safe(bat, bowl, ["player"], keys)
    merged = {c: F.coalesce(F.col(c), F.col(f"bowl_{c}")) for c in shared}
    return joined.withColumns(merged).drop(*[f"bowl_{c}" for c in shared])


def dim_player(batting: DataFrame, bowling: DataFrame, rule: RoleRule = RoleRule()) -> DataFrame:
    careers = joined_careers(batting, bowling).withColumns(
        {
            "player_role": player_role(F.col("wickets"), F.col("runs"), rule),
            "pca_batting_score": batting_score(),
            "pca_bowling_score": bowling_score(),
        }
    )
    headline = headline_score(
        F.col("player_role"), F.col("pca_batting_score"), F.col("pca_bowling_score")
    )
    return careers.select(
        "player",
        "country_tag",
        "career_start_year",
        "career_end_year",
        "matches",
        "innings",
        "runs",
        "wickets",
        "player_role",
        headline.alias("pca_score"),
        "pca_batting_score",
        "pca_bowling_score",
    )


def fact_career_stats(batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """(player, metric_name, metric_value), one scan per side."""
    return unpivot_metrics(batting, ["player"], BATTING_METRICS).unionByName(
        unpivot_metrics(bowling, ["player"], BOWLING_METRICS)
    )


def is_ranked_batsman(rule: MartRule = MartRule()) -> Column:
    return (
        F.col("player_role").isin("batsman", "all_rounder")
        & (F.col("matches") >= rule.min_matches)
        & F.col("runs").isNotNull()
    )


def is_ranked_bowler(rule: MartRule = MartRule()) -> Column:
    return F.col("player_role").isin("bowler", "all_rounder") & (
        F.col("wickets") >= rule.min_wickets
    )


def best_first() -> list[Column]:
    """Order of the ranking marts: score, then player and start year to settle ties."""
    return [
        F.col("pca_score").desc_nulls_last(),
        F.col("player").asc_nulls_last(),
        F.col("career_start_year").asc_nulls_last(),
    ]


def batsmen(dim: DataFrame, rule: MartRule = MartRule()) -> DataFrame:
    """Rows of the batting mart without their rank."""
    return dim.where(is_ranked_batsman(rule)).select(
        "player",
        "country_tag",
        "career_start_year",
        "career_end_year",
        "matches",
        "innings",
        "runs",
        F.col("pca_batting_score").alias("pca_score"),
    )


def bowlers(dim: DataFrame, rule: MartRule = MartRule()) -> DataFrame:
    """Rows of the bowling mart without their rank."""
    return dim.where(is_ranked_bowler(rule)).select(
        "player",
        "country_tag",
        "career_start_year",
        "career_end_year",
        "matches",
        "wickets",
        F.col("pca_bowling_score").alias("pca_score"),
    )


def mart_top_batsmen(dim: DataFrame, rule: MartRule = MartRule(), folder: str | None = None) -> DataFrame:
    return global_rank(batsmen(dim, rule), *best_first(), folder=folder)


def mart_top_bowlers(dim: DataFrame, rule: MartRule = MartRule(), folder: str | None = None) -> DataFrame:
    return global_rank(bowlers(dim, rule), *best_first(), folder=folder)


def player_stats_wide(
    batting: DataFrame,
    bowling: DataFrame,
    buckets: int | None = None,
    salt_by: Sequence[str] | None = None,
    rows_per_task: int = 1_000_000,
    by: str | None = None,
) -> DataFrame:
    """Batting rows with the player's bowling rows, salted because few players hold many rows.

    Players with more than ``rows_per_task`` rows get as many salts as their rows ask for; ``buckets``
    salts every player alike instead. ``salt_by`` names the columns that tell batting rows apart.
    ``by`` names a column that must agree on both sides besides the player, such as the ingestion date:
    without it the rows of all days meet those of all days.
    """

    def keyed(df: DataFrame) -> DataFrame:
        key = clean_name(F.col(first_present(df, ["player", "Player"])))
        return df.withColumn("player_clean", F.concat(F.col(by).cast("string"), F.lit(" "), key) if by else key)

    left = keyed(batting)
    right = prefixed(keyed(bowling).drop(*([by] if by else [])), "bowl_", ["player_clean"])
    if buckets is None:
        joined = hot_key_join(left, right, "player_clean", rows_per_task, salt_by)
    else:
        joined = salted_join(left, right, "player_clean", buckets, salt_by)
    return joined.drop("player_clean")


# ------------------------------------------------------------------- ball by ball


def dim_player_source(balls: DataFrame) -> DataFrame:
    """Everyone who bats, bowls or gets out, with a surrogate key; the balls are read once."""
    names = distinct_values(balls, ["batter", "bowler", "player_out"], "player_name")
    return names.select(surrogate_key(F.col("player_name")).alias("player_id"), "player_name")


def dim_venue(matches: DataFrame) -> DataFrame:
    """Venue and city with a surrogate key; the hash is taken after the distinct."""
    places = matches.where(F.col("venue").isNotNull()).select("venue", "city").distinct()
    return places.select(
        surrogate_key(F.col("venue"), F.col("city")).alias("venue_id"),
        F.col("venue").alias("venue_name"),
        "city",
    )


READINGS = ("temp_max_c", "precip_mm", "rain_mm")


def weather_key() -> Column:
    """Key of a set of readings, from all of them, at six decimals."""
    return surrogate_key(*[reading_text(F.col(c)) for c in READINGS])


def dim_weather(weather: DataFrame) -> DataFrame:
    """One row per set of readings, with its key and band; readings without a temperature have none."""
    keyed = weather.where(F.col("temp_max_c").isNotNull()).select(weather_key().alias("weather_id"), *READINGS)
    readings = keyed.groupBy("weather_id").agg(*[(F.min(c) + F.lit(0.0)).alias(c) for c in READINGS])
    return readings.withColumn("weather_condition", weather_band(F.col("temp_max_c"), F.col("precip_mm")))


def fact_ball_by_ball(balls: DataFrame, matches: DataFrame, weather: DataFrame) -> DataFrame:
    """Every ball with its match date and the keys of its dimensions.

    Matches and weather meet first, per match, so the balls are shuffled for one
    join only and Spark may split a hot match in it. Their keys are hashed per
    match, not per ball.
    """
    venue_id = surrogate_key(F.col("venue"), F.col("city"))
    per_match = (
        matches.select("match_id", "match_date", "venue", "city")
        .join(weather.select("match_id", *READINGS), "match_id", "full_outer")
        .select("match_id", "match_date", venue_id.alias("venue_id"), weather_key().alias("weather_id"))
    )
    no_venue = surrogate_key(F.lit(None), F.lit(None))
    no_weather = surrogate_key(*[F.lit(None)] * len(READINGS))
    return balls.join(per_match, "match_id", "left").select(
        "match_id",
        "match_date",
        F.coalesce("venue_id", no_venue).alias("venue_id"),
        F.coalesce("weather_id", no_weather).alias("weather_id"),
        surrogate_key(F.col("batter")).alias("batter_id"),
        surrogate_key(F.col("bowler")).alias("bowler_id"),
        "batting_team",
        "over_num",
        "runs_batter",
        "runs_extras",
        "runs_total",
        "wicket_kind",
        F.col("player_out").isNotNull().cast("int").alias("is_wicket"),
    )
