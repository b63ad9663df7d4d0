"""Bronze to Silver: raw career tables to typed tables with one row per player and start year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.functions.numbers import exact_int, number_text, safe_double
from pavilion.functions.text import clean_name, has_mark, name_tag, span_years, without_mark
from pavilion.operators.columns import (
    complete_schema,
    drop_index_columns,
    first_present,
    rename_known,
)
from pavilion.operators.dedupe import dedupe_max
from pavilion.schemas import SILVER_BATTING, SILVER_BOWLING

# Source headers and their conformed names (fixed values). Batting comes in two spellings.
BATTING_ALIASES = {
    "Player": "player_raw",
    "Span": "span_raw",
    "Start": "career_start_raw",
    "End": "career_end_raw",
    "Country": "country_explicit",
    "Mat": "matches",
    "Matches": "matches",
    "Inns": "innings",
    "Innings": "innings",
    "NO": "not_outs",
    "NotOuts": "not_outs",
    "Runs": "runs",
    "HS": "high_score_raw",
    "Ave": "average",
    "Average": "average",
    "BF": "balls_faced",
    "BallsFaced": "balls_faced",
    "SR": "strike_rate",
    "StrikeRate": "strike_rate",
    "100": "hundreds",
    "Hundreds": "hundreds",
    "50": "fifties",
    "Fifties": "fifties",
    "0": "ducks",
    "Ducks": "ducks",
    "4s": "fours_raw",
    "6s": "sixes_raw",
}
# Opt-in: the second spelling's high score, which the default map leaves out.
HIGH_SCORE_ALIASES = {"HighScore": "high_score_raw", "HighScoreNotOut": "high_score_not_out_raw"}
BOWLING_ALIASES = {
    "Player": "player_raw",
    "Span": "span_raw",
    "Mat": "matches",
    "Inns": "innings",
    "Balls": "balls_bowled",
    "Runs": "runs_conceded",
    "Wkts": "wickets",
    "BBI": "best_bowling_innings",
    "Ave": "bowling_average",
    "Econ": "economy_rate",
    "SR": "bowling_strike_rate",
    "4": "four_wicket_hauls",
    "5": "five_wicket_hauls",
}
NATURAL_KEY = ["player", "career_start_year"]
# Columns whose trailing mark becomes a flag.
_MARKS = {
    "fours": ("+", "fours_is_lower_bound"),
    "sixes": ("+", "sixes_is_lower_bound"),
    "high_score": ("*", "high_score_not_out"),
}
_FLAGS = {flag: False for _, flag in _MARKS.values()}


def _identity_columns(df: DataFrame) -> dict[str, Column]:
    """Player, country tag and career years, from whichever columns the source has."""
    raw = F.col("player_raw")
    out = {"player": clean_name(raw), "country_tag": name_tag(raw)}
    for explicit in ("country_explicit", "country_tag"):
        if explicit in df.columns:
            out["country_tag"] = F.col(explicit).cast("string")
    if "span_raw" in df.columns:
        out["career_start_year"], out["career_end_year"] = span_years(F.col("span_raw"))
    else:
        for name in ("career_start", "career_end"):
            if f"{name}_raw" in df.columns:
                out[f"{name}_year"] = number_text(F.col(f"{name}_raw"))
    return out


def _marked_columns(df: DataFrame) -> dict[str, Column]:
    out = {}
    for name, (mark, flag) in _MARKS.items():
        if f"{name}_raw" in df.columns:
            text = F.col(f"{name}_raw")
            out[name] = number_text(without_mark(text, mark))
            out[flag] = has_mark(text, mark)
    if "high_score_not_out_raw" in df.columns:
        explicit = F.col("high_score_not_out_raw").cast("string").try_cast("boolean")
        out["high_score_not_out"] = F.coalesce(explicit, F.lit(False))
    return out


def _conform(df: DataFrame, aliases: Mapping[str, str], schema: T.StructType) -> DataFrame:
    renamed = rename_known(drop_index_columns(df), aliases)
    if "player_raw" not in renamed.columns:
        # Already conformed spelling, for instance a Silver table passed again.
        renamed = renamed.withColumnRenamed("player", "player_raw")
    integral = {f.name for f in renamed.schema.fields if isinstance(f.dataType, T.IntegralType)}

    def as_read(field: T.StructField) -> Column:
        value = F.col(field.name)
        if field.dataType == T.DoubleType():
            return safe_double(value)
        if field.dataType == T.LongType():
            return value.cast("bigint") if field.name in integral else number_text(value)
        return value

    read = {f.name: as_read(f) for f in schema.fields if f.name in renamed.columns}
    read |= _identity_columns(renamed) | _marked_columns(renamed)
    # Two projections: sorting out junk and reading whole numbers in one would make a
    # method too large for the JVM to compile.
    parsed = renamed.select(*[value.alias(name) for name, value in read.items()])
    texts = {name for name, dtype in parsed.dtypes if dtype == "string"}
    wholes = [f.name for f in schema.fields if f.dataType == T.LongType() and f.name in texts]
    typed = parsed.withColumns({name: exact_int(F.col(name)) for name in wholes})
    return complete_schema(typed, schema, _FLAGS)


def type_batting(df: DataFrame, with_high_score: bool = False) -> DataFrame:
    """Batting rows in Silver types, before rows are dropped."""
    aliases = BATTING_ALIASES | (HIGH_SCORE_ALIASES if with_high_score else {})
    return _conform(df, aliases, SILVER_BATTING)


def type_bowling(df: DataFrame) -> DataFrame:
    """Bowling rows in Silver types, before rows are dropped."""
    return _conform(df, BOWLING_ALIASES, SILVER_BOWLING)


def named(df: DataFrame) -> DataFrame:
    """Rows with a player.

    Testing the raw column lets the scan drop the rows; the same test on the
    cleaned name would clean every name twice.
    """
    return df.where(F.col(first_present(df, ["Player", "player"])).isNotNull())


def conform_batting(df: DataFrame, with_high_score: bool = False) -> DataFrame:
    """Rows with a player and runs, one per natural key."""
    typed = type_batting(named(df), with_high_score).where("runs is not null")
    return dedupe_max(typed, NATURAL_KEY, "matches")


def conform_bowling(df: DataFrame) -> DataFrame:
    """Rows with a player and at least one wicket, one per natural key."""
    typed = type_bowling(named(df)).where("wickets > 0")
    return dedupe_max(typed, NATURAL_KEY, "matches")
