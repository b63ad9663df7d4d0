"""Declared rules of the Silver tables, the warehouse tests and the transaction contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from pavilion.config import (
    BATTING_GATE,
    BOWLING_GATE,
    FIRST_YEAR,
    BattingLimits,
    BowlingLimits,
    GateRule,
)
from pavilion.operators.quality import Contract, FieldRule, RowRule, TableTest

# Columns that a source may lack altogether (fixed values).
MAY_BE_ALL_NULL = frozenset(
    {
        "fours",
        "sixes",
        "fours_is_lower_bound",
        "sixes_is_lower_bound",
        "high_score",
        "high_score_not_out",
        "country_tag",
        "career_start_year",
        "career_end_year",
    }
)

_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()


def _not_negative(*names: str, dtype: T.DataType = _LONG) -> list[FieldRule]:
    return [FieldRule(n, dtype, ge=0) for n in names]


def _identity(last_year: int) -> list[FieldRule]:
    return [
        FieldRule("player", _TEXT, required=True, min_length=1),
        FieldRule("country_tag", _TEXT),
        FieldRule("career_start_year", _LONG, ge=FIRST_YEAR, le=last_year),
        FieldRule("career_end_year", _LONG, ge=FIRST_YEAR, le=last_year),
        *_not_negative("matches", "innings"),
    ]


def _next_year() -> int:
    return dt.datetime.now(dt.UTC).year + 1


SPAN_RULE = RowRule(
    "career_span_valid",
    ("career_start_year", "career_end_year"),
    lambda: F.col("career_end_year") >= F.col("career_start_year"),
)


def batting_contract(
    limits: BattingLimits = BattingLimits(), last_year: int | None = None
) -> Contract:
    rules = [
        *_identity(last_year or _next_year()),
        FieldRule("runs", _LONG, required=True, ge=0, le=limits.runs_max),
        FieldRule("average", _DOUBLE, ge=0),
        FieldRule("strike_rate", _DOUBLE, ge=0, le=limits.strike_rate_max),
        *_not_negative("hundreds", "fifties"),
    ]
    return Contract("batting", tuple(rules), (SPAN_RULE,), MAY_BE_ALL_NULL)


def bowling_contract(
    limits: BowlingLimits = BowlingLimits(), last_year: int | None = None
) -> Contract:
    rules = [
        *_identity(last_year or _next_year()),
        *_not_negative("balls_bowled", "runs_conceded"),
        FieldRule("wickets", _LONG, required=True, gt=0, le=limits.wickets_max),
        FieldRule("bowling_average", _DOUBLE, ge=0),
        FieldRule("economy_rate", _DOUBLE, ge=0, le=limits.economy_max),
        FieldRule("bowling_strike_rate", _DOUBLE, ge=0),
    ]
    return Contract("bowling", tuple(rules), (), MAY_BE_ALL_NULL)


def silver_contracts(
    batting: GateRule = BATTING_GATE, bowling: GateRule = BOWLING_GATE
) -> dict[str, tuple[Contract, GateRule]]:
    return {"batting": (batting_contract(), batting), "bowling": (bowling_contract(), bowling)}


def _not_null(table: str, *columns: str) -> list[TableTest]:
    return [TableTest(table, c, "not_null") for c in columns]


def _unique(table: str, *columns: str) -> list[TableTest]:
    return [TableTest(table, c, "unique") for c in columns]


def source_tests() -> list[TableTest]:
    """Tests of the Silver tables."""
    return [*_not_null("batting", "player", "runs"), *_not_null("bowling", "player", "wickets")]


def model_tests() -> list[TableTest]:
    """Tests of the staging and Gold tables."""
    from pavilion.plans.marts import BATTING_METRICS, BOWLING_METRICS

    limits, bowl_limits = BattingLimits(), BowlingLimits()
    metrics = tuple([*BATTING_METRICS, *BOWLING_METRICS])
    roles = ("batsman", "bowler", "all_rounder")
    ranked = ("rank", "player")
    return [
        *_not_null("stg_batting", "player", "runs"),
        TableTest("stg_batting", "runs", "accepted_range", low=0, high=limits.runs_max),
        TableTest(
            "stg_batting",
            "strike_rate",
            "accepted_range",
            low=0,
            high=limits.strike_rate_max,
            where="strike_rate is not null",
        ),
        *_not_null("stg_bowling", "player", "wickets"),
        TableTest("stg_bowling", "wickets", "accepted_range", low=1, high=bowl_limits.wickets_max),
        *_not_null("dim_player", "player"),
        *_unique("dim_player", "player"),
        *_not_null("dim_player", "player_role"),
        TableTest("dim_player", "player_role", "accepted_values", values=roles),
        *_not_null("fact_career_stats", "player", "metric_name"),
        TableTest("fact_career_stats", "metric_name", "accepted_values", values=metrics),
        *_not_null("fact_career_stats", "metric_value"),
        *[
            test
            for mart in ("mart_top_batsmen", "mart_top_bowlers")
            for test in (
                *_not_null(mart, *ranked),
                *_unique(mart, *ranked),
                *_not_null(mart, "pca_score"),
            )
        ],
    ]


def match_tests() -> list[TableTest]:
    """Tests of the matches: one row per match."""
    return [*_not_null("matches", "match_id"), *_unique("matches", "match_id")]


def silver_ball_tests() -> list[TableTest]:
    """Tests of the tables that the balls are joined with: one row per match."""
    return [*match_tests(), *_unique("weather", "match_id")]


def ball_tests() -> list[TableTest]:
    """Tests of the ball-by-ball tables: unique keys, and facts that find their dimensions."""
    fact = "fact_ball_by_ball"
    return [
        *_unique("dim_player_source", "player_id"),
        *_unique("dim_venue", "venue_id"),
        *_unique("dim_weather", "weather_id"),
        *_not_null(fact, "match_id", "batter_id", "bowler_id"),
        TableTest(fact, "match_id", "references", to=("matches", "match_id")),
        TableTest(fact, "batter_id", "references", to=("dim_player_source", "player_id")),
        TableTest(fact, "bowler_id", "references", to=("dim_player_source", "player_id")),
    ]


def transaction_contract(
    transaction_id: str = "transaction_id",
    user_id: str = "user_id",
    amount: str = "amount",
    timestamp: str = "timestamp",
    min_amount: float = 0.01,
    id_type: T.DataType = _TEXT,
    timestamp_type: T.DataType = T.TimestampType(),
) -> Contract:
    """User transactions: required columns, a unique id and a positive amount."""
    return Contract(
        "transactions",
        (
            FieldRule(transaction_id, id_type, required=True, unique=True),
            FieldRule(user_id, id_type, required=True),
            FieldRule(amount, _DOUBLE, required=True, ge=min_amount),
            FieldRule(timestamp, timestamp_type, required=True),
        ),
    )
