"""Explicit schemas: no read infers types, so a file without optional fields still fits."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, DOUBLE, FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def _texts(names: str) -> T.StructType:
    return T.StructType([T.StructField(name, TEXT) for name in names.split()])


BRONZE_BATTING = _texts("Player Span Mat Inns NO Runs HS Ave BF SR 100 50 0 4s 6s")
BRONZE_BOWLING = _texts("Player Span Mat Inns Balls Runs Wkts BBI Ave Econ SR 4 5")

SILVER_BATTING = _struct(
    player=TEXT,
    country_tag=TEXT,
    career_start_year=LONG,
    career_end_year=LONG,
    matches=LONG,
    innings=LONG,
    not_outs=LONG,
    runs=LONG,
    balls_faced=LONG,
    hundreds=LONG,
    fifties=LONG,
    ducks=LONG,
    average=DOUBLE,
    strike_rate=DOUBLE,
    fours=LONG,
    fours_is_lower_bound=FLAG,
    sixes=LONG,
    sixes_is_lower_bound=FLAG,
    high_score=LONG,
    high_score_not_out=FLAG,
)

SILVER_BOWLING = _struct(
    player=TEXT,
    country_tag=TEXT,
    career_start_year=LONG,
    career_end_year=LONG,
    matches=LONG,
    innings=LONG,
    balls_bowled=LONG,
    runs_conceded=LONG,
    wickets=LONG,
    four_wicket_hauls=LONG,
    five_wicket_hauls=LONG,
    bowling_average=DOUBLE,
    economy_rate=DOUBLE,
    bowling_strike_rate=DOUBLE,
    best_bowling_innings=TEXT,
)

_WICKET = _struct(kind=TEXT, player_out=TEXT)
_DELIVERY = _struct(
    batter=TEXT,
    bowler=TEXT,
    runs=_struct(batter=LONG, extras=LONG, total=LONG),
    wickets=T.ArrayType(_WICKET),
)
_OVER = _struct(over=LONG, deliveries=T.ArrayType(_DELIVERY))
_INNINGS = _struct(team=TEXT, overs=T.ArrayType(_OVER))
_INFO = _struct(
    dates=T.ArrayType(TEXT),
    venue=TEXT,
    city=TEXT,
    teams=T.ArrayType(TEXT),
    match_type=TEXT,
)
MATCH_DOCUMENT = _struct(info=_INFO, innings=T.ArrayType(_INNINGS))

_READINGS = T.ArrayType(DOUBLE)
WEATHER_DOCUMENT = _struct(
    match_id=TEXT,
    daily=_struct(
        time=T.ArrayType(TEXT),
        temperature_2m_max=_READINGS,
        precipitation_sum=_READINGS,
        rain_sum=_READINGS,
    ),
)

GEOCODE_DOCUMENT = _struct(results=T.ArrayType(_struct(latitude=DOUBLE, longitude=DOUBLE)))


def with_key(document: T.StructType, key: str = "match_id") -> T.StructType:
    """The document schema with a leading string key column."""
    return T.StructType([T.StructField(key, TEXT), *document.fields])
