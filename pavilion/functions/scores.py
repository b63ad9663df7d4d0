"""Composite scores, player roles and weather bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from pavilion.config import BATTING_WEIGHTS, BOWLING_WEIGHTS, RoleRule


def weighted_score(terms: Sequence[tuple[float, Column]]) -> Column:
    """Sum of weight times value, left to right so that floating-point results repeat."""
    return reduce(lambda total, term: total + term, [F.lit(w) * value for w, value in terms])


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("double")


def batting_score(
    runs: str = "runs",
    average: str = "batting_average",
    strike_rate: str = "batting_strike_rate",
    fours: str = "fours",
    sixes: str = "sixes",
    hundreds: str = "hundreds",
    fifties: str = "fifties",
) -> Column:
    values = {
        "runs": _or_zero(runs),
        "average": _or_zero(average),
        "strike_rate": _or_zero(strike_rate),
        "fours": _or_zero(fours),
        "sixes": _or_zero(sixes),
        "centuries": _or_zero(hundreds) + _or_zero(fifties),
    }
    return weighted_score([(w, values[name]) for name, w in BATTING_WEIGHTS.items()])


def bowling_score(
    wickets: str = "wickets",
    bowling_average: str = "bowling_average",
    economy_rate: str = "economy_rate",
    bowling_strike_rate: str = "bowling_strike_rate",
) -> Column:
    """Wickets count for a bowler, the other three against; may be negative."""
    values = {
        "wickets": _or_zero(wickets),
        "bowling_average": _or_zero(bowling_average),
        "economy_rate": _or_zero(economy_rate),
        "bowling_strike_rate": _or_zero(bowling_strike_rate),
    }
    return weighted_score([(w, values[name]) for name, w in BOWLING_WEIGHTS.items()])


def player_role(wickets: Column, runs: Column, rule: RoleRule = RoleRule()) -> Column:
    few_wickets = wickets.isNull() | (wickets < rule.min_wickets)
    few_runs = runs.isNull() | (runs < rule.min_runs)
    return F.when(few_wickets, "batsman").when(few_runs, "bowler").otherwise("all_rounder")


def headline_score(role: Column, batting: Column, bowling: Column) -> Column:
    """The score that fits the role; whichever exists for any other role."""
    return (
        F.when(role.isin("batsman", "all_rounder"), batting)
        .when(role == "bowler", bowling)
        .otherwise(F.coalesce(batting, bowling))
    )


def weather_band(temp_max_c: Column, precip_mm: Column) -> Column:
    return (
        F.when(precip_mm > 5, "Rainy")
        .when(temp_max_c > 30, "Hot")
        .when(temp_max_c < 15, "Cold")
        .otherwise("Moderate")
    )
