"""Typed views over Silver, one row per player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pavilion.operators.dedupe import dedupe_earliest
from pavilion.sources.tables import DATE_COLUMN

# Staged columns in order, with their SQL types.
_LEAD = {
    "player": "string",
    "country_tag": "string",
    "career_start_year": "bigint",
    "career_end_year": "bigint",
    "matches": "int",
    "innings": "int",
}
BATTING_COLUMNS = _LEAD | {
    "not_outs": "int",
    "runs": "int",
    "average": "double",
    "balls_faced": "int",
    "strike_rate": "double",
    "hundreds": "int",
    "fifties": "int",
    "ducks": "int",
    "fours": "int",
    "sixes": "int",
    "high_score": "int",
    "high_score_not_out": "boolean",
}
BOWLING_COLUMNS = _LEAD | {
    "balls_bowled": "int",
    "runs_conceded": "int",
    "wickets": "int",
    "bowling_average": "double",
    "economy_rate": "double",
    "bowling_strike_rate": "double",
    "four_wicket_hauls": "int",
    "five_wicket_hauls": "int",
    "best_bowling_innings": "string",
}


def _staged(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Staged columns of each player's earliest career; the newest ingestion wins a tie."""
    date = [DATE_COLUMN] if DATE_COLUMN in df.columns else []
    typed = df.selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in columns.items()], *date)
    return dedupe_earliest(typed, ["player"], "career_start_year", DATE_COLUMN).drop(DATE_COLUMN)


def stg_batting(silver: DataFrame) -> DataFrame:
    return _staged(silver.where("runs is not null"), BATTING_COLUMNS)


def stg_bowling(silver: DataFrame) -> DataFrame:
    return _staged(silver.where("wickets > 0"), BOWLING_COLUMNS)


def stg_matches(silver: DataFrame) -> DataFrame:
    return silver.select(
        "match_id", "match_date", "venue", "city", "team1", "team2", "match_type"
    )


def stg_balls(silver: DataFrame) -> DataFrame:
    return silver.select(
        "match_id",
        "batting_team",
        "over_num",
        "batter",
        "bowler",
        "runs_batter",
        "runs_extras",
        "runs_total",
        "wicket_kind",
        "player_out",
    )


def stg_weather(
    silver: DataFrame, missing: float | None = 0.0, rain: float | None = None
) -> DataFrame:
    """Readings as doubles. ``missing`` replaces absent ones; ``rain`` fixes the rain column.

    With ``missing=0.0`` a match without a temperature counts as cold; pass None to keep nulls.
    """

    def reading(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(missing).cast("double")).alias(name)

    rain_mm = reading("rain_mm") if rain is None else F.lit(float(rain)).alias("rain_mm")
    return silver.select("match_id", reading("temp_max_c"), reading("precip_mm"), rain_mm)
