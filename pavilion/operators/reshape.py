"""Wide to long, nested to flat, columns to values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """One row per id and metric with a value; ``metrics`` maps metric name to column.

    A single scan, however many metrics there are.
    """
    wide = df.select(*ids, *[F.col(c).cast("double").alias(m) for m, c in metrics.items()])
    long = wide.unpivot(list(ids), list(metrics), "metric_name", "metric_value")
    return long.where(F.col("metric_value").isNotNull())


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct non-null values of several columns, from one scan."""
    values = df.select(F.explode(F.array(*columns)).alias(name))
    return values.where(F.col(name).isNotNull()).distinct()


def unnest(df: DataFrame, array: str, keep: Sequence[Column | str], outer: bool = False) -> DataFrame:
    """One row per struct in ``array``, its fields beside ``keep``.

    Rows with a null or empty array vanish unless ``outer`` is set.
    """
    spread = F.inline_outer if outer else F.inline
    return df.select(*keep, spread(array))


def first_item(array: str | Column) -> Column:
    """First element, or null for an empty or null array."""
    return F.get(F.col(array) if isinstance(array, str) else array, F.lit(0))


def flatten_matches(docs: DataFrame) -> DataFrame:
    """One header row per match document."""
    teams = F.col("info.teams")
    return docs.select(
        "match_id",
        first_item("info.dates").alias("match_date"),
        "info.venue",
        "info.city",
        F.get(teams, F.lit(0)).alias("team1"),
        F.get(teams, F.lit(1)).alias("team2"),
        "info.match_type",
    )


def flatten_balls(docs: DataFrame) -> DataFrame:
    """One row per delivery; a second wicket on a delivery is ignored."""
    innings = unnest(docs, "innings", ["match_id"])
    overs = unnest(innings, "overs", ["match_id", F.col("team").alias("batting_team")])
    balls = unnest(
        overs, "deliveries", ["match_id", "batting_team", F.col("over").alias("over_num")]
    )
    wicket = first_item("wickets")
    runs = {f"runs_{part}": F.col(f"runs.{part}") for part in ("batter", "extras", "total")}
    return balls.select(
        "match_id",
        "batting_team",
        "over_num",
        "batter",
        "bowler",
        *[value.alias(name) for name, value in runs.items()],
        wicket["kind"].alias("wicket_kind"),
        wicket["player_out"].alias("player_out"),
    )


def flatten_weather(docs: DataFrame) -> DataFrame:
    """First day of each weather document."""
    return docs.select(
        "match_id",
        first_item("daily.time").alias("date"),
        first_item("daily.temperature_2m_max").alias("temp_max_c"),
        first_item("daily.precipitation_sum").alias("precip_mm"),
        first_item("daily.rain_sum").alias("rain_mm"),
    )
