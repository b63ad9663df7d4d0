"""Scalar functions on the documented cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pavilion.functions import keys, numbers, scores, text


def column(spark, values, *expressions, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [tuple(r) for r in df.select(*[e(F.col("x")).alias(f"c{i}") for i, e in enumerate(expressions)]).collect()]


def test_name_and_tag(spark):
    names = ["Nell Orme (West/WQ)", "Lou van Tey", "IP Quist ", "A\u00a0(B) (C) ", None, "X (Y(Z)"]
    assert column(spark, names, text.clean_name, text.name_tag) == [
        ("nell orme", "west/wq"),
        ("lou van tey", None),
        ("ip quist", None),
        ("a\u00a0(b)", "c"),
        (None, None),
        ("x", "y(z"),
    ]


def test_span(spark):
    spans = ["1908-1921", "1933", "1950-", "none", "1908-19211", None]
    years = column(spark, spans, lambda c: text.span_years(c)[0], lambda c: text.span_years(c)[1])
    assert years == [(1908, 1921)] + [(None, None)] * 5


@pytest.mark.parametrize(
    ("mark", "values", "expected"),
    [
        ("+", ["33+", "7", "941+", "-", None], [(33, True), (7, False), (941, True), (None, False), (None, False)]),
        ("*", ["58*", "6", "119*"], [(58, True), (6, False), (119, True)]),
    ],
)
def test_marks(spark, mark, values, expected):
    found = column(
        spark, values, lambda c: text.marked_number(c, mark)[0], lambda c: text.marked_number(c, mark)[1]
    )
    assert found == expected


def test_safe_casts(spark):
    values = ["452", "452.0", "452.7", " 12 ", "-", "", "12d", "0x1p3", "1e3", "-7", "nan", None]
    whole, double = zip(*column(spark, values, numbers.safe_int, numbers.safe_double), strict=True)
    assert list(whole) == [452, 452, None, 12, None, None, None, None, 1000, -7, None, None]
    assert list(double) == [452.0, 452.0, 452.7, 12.0, None, None, None, None, 1000.0, -7.0, None, None]
    infinite = column(spark, ["inf", "-Infinity", "1e400"], numbers.safe_int, numbers.safe_double)
    assert infinite == [(None, float("inf")), (None, float("-inf")), (None, float("inf"))]


def test_safe_int_of_doubles(spark):
    values = [452.0, 1.5e7, 0.5, float("inf"), float("nan"), None]
    found = column(spark, values, numbers.safe_int, dtype="double")
    assert [v for (v,) in found] == [452, 15000000, None, None, None, None]


def test_integers_beyond_doubles(spark):
    values = ["9007199254740993", "-9007199254740993", "+5", "9223372036854775807", "99999999999999999999", "9007199254740993.0"]
    found = [v for (v,) in column(spark, values, numbers.safe_int)]
    assert found == [9007199254740993, -9007199254740993, 5, 9223372036854775807, None, 9007199254740992]


def test_reading_text(spark):
    found = column(spark, [0.0, -0.0, 0.0004, 12.5, None], keys.reading_text, dtype="double")
    assert [v for (v,) in found] == ["0.000000", "0.000000", "0.000400", "12.500000", None]


def test_file_key_and_search(spark):
    paths = ["s3a://b/123.json", "b/x1.txt", "b/77.json.gz"]
    assert column(spark, paths, text.file_key) == [("123",), ("",), ("77",)]
    names = ["P_1", "p21", "Pat"]
    wild = column(spark, names, lambda c: text.contains_text(c, "p_1"))
    literal = column(spark, names, lambda c: text.contains_text(c, "p_1", literal=True))
    assert [v for (v,) in wild] == [True, True, False]
    assert [v for (v,) in literal] == [True, False, False]
    assert column(spark, names, lambda c: text.same_text(c, "PAT")) == [(False,), (False,), (True,)]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), (None, None)], "x string, y string")
    ids = [r[0] for r in df.select(keys.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 4 and None not in ids


def test_bands_and_roles(spark):
    weather = spark.createDataFrame(
        [(35.0, 6.0), (35.0, 5.0), (30.0, 0.0), (14.9, 0.0), (15.0, None), (None, 1.0)], "t double, p double"
    )
    bands = [r[0] for r in weather.select(scores.weather_band(F.col("t"), F.col("p"))).collect()]
    assert bands == ["Rainy", "Hot", "Moderate", "Cold", "Moderate", "Moderate"]
    people = spark.createDataFrame(
        [(None, 900), (49, 900), (50, None), (50, 499), (50, 500), (None, None)], "w int, r int"
    )
    roles = [r[0] for r in people.select(scores.player_role(F.col("w"), F.col("r"))).collect()]
    assert roles == ["batsman", "batsman", "bowler", "bowler", "all_rounder", "batsman"]


def test_scores(spark):
    df = spark.createDataFrame(
        [(100, 50.0, 80.0, None, 2, 1, 3, 10, 20.0, 4.5, 30.0)],
        "runs int, batting_average double, batting_strike_rate double, fours int, sixes int, "
        "hundreds int, fifties int, wickets int, bowling_average double, economy_rate double, "
        "bowling_strike_rate double",
    )
    batting, bowling = df.select(scores.batting_score(), scores.bowling_score()).first()
    assert batting == pytest.approx(0.458 * 100 + 0.398 * 50 + 0.325 * 80 + 0.417 * 2 + 0.432 * 4)
    assert bowling == pytest.approx(0.428 * 10 - 0.591 * 20 - 0.383 * 4.5 - 0.566 * 30)
