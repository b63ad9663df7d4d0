"""Bronze to Silver and staging."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pavilion.operators import columns
from pavilion.operators.dedupe import dedupe_max
from pavilion.plans import conform, staging
from pavilion.schemas import BRONZE_BOWLING, SILVER_BATTING, SILVER_BOWLING

MIXED = {
    "Player": "Ruta Vale (ZED)", "Span": "1931-1947", "Mat": 61, "Inns": 77, "NO": 12, "Runs": 3107, "HS": "206*",
    "Ave": 47.75, "BF": 6893, "SR": 45.07, "100": 8, "50": 11, "0": 6, "4s": "271+", "6s": "19",
}


def frame(spark, *rows):
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], names)


def explicit_spelling(spark):
    header = (
        "Player string, Country string, Start bigint, End bigint, Matches bigint, Innings string, "
        "NotOuts string, Runs string, HighScore string, HighScoreNotOut boolean, Average string, "
        "BallsFaced string, StrikeRate string, Hundreds string, Fifties string, Ducks string"
    )
    rows = [
        ("Ilse Moor ", "North/NX", 1961, 1974, 88, "131.0", "17.0", "5204.0", "177.0", True, "45.64", "9911.0", "52.5", "12.0", "31.0", "7.0"),
        ("Jory Pell", "SX", 1970, 1972, 4, None, None, None, None, False, None, None, None, None, None, None),
        ("Kit Rowe", "EX", 1983, 1985, 6, "3.0", "3.0", "41.0", "41.0", True, "inf", "55.0", "74.5", "0.0", "0.0", "0.0"),
    ]
    return spark.createDataFrame(rows, header)


def test_marks_numbers_and_schema(spark):
    out = conform.conform_batting(frame(spark, MIXED))
    assert out.schema.simpleString() == SILVER_BATTING.simpleString()
    row = out.first().asDict()
    expected = {
        "player": "ruta vale", "country_tag": "zed", "career_start_year": 1931, "high_score": 206,
        "high_score_not_out": True, "fours": 271, "fours_is_lower_bound": True, "sixes": 19,
        "sixes_is_lower_bound": False, "average": 47.75, "runs": 3107, "hundreds": 8, "ducks": 6,
    }
    assert {k: row[k] for k in expected} == expected


def test_explicit_spelling(spark):
    rows = {r["player"]: r for r in conform.conform_batting(explicit_spelling(spark)).collect()}
    assert set(rows) == {"ilse moor", "kit rowe"}  # the row without runs is dropped
    first = rows["ilse moor"]
    assert (first["country_tag"], first["innings"], first["runs"]) == ("North/NX", 131, 5204)
    assert (first["career_start_year"], first["career_end_year"]) == (1961, 1974)
    assert first["high_score"] is None and first["high_score_not_out"] is False
    assert rows["kit rowe"]["average"] == float("inf")
    wide = conform.conform_batting(explicit_spelling(spark), with_high_score=True)
    assert {(r["high_score"], r["high_score_not_out"]) for r in wide.collect()} == {(177, True), (41, True)}


def test_natural_key_is_unique_and_repeatable(spark):
    base = [{**MIXED, "Player": f"P{i} (X)", "Mat": i} for i in range(20)]
    copies = [{**r, "Mat": r["Mat"] - 1, "Runs": 1} for r in base]
    once = conform.conform_batting(frame(spark, *base)).collect()
    twice = conform.conform_batting(frame(spark, *copies, *base, *base)).collect()
    assert sorted(once) == sorted(twice)


def test_null_start_years_are_one_key(spark):
    rows = [{**MIXED, "Span": "bad", "Mat": m} for m in (1, 9, 4)]
    (row,) = conform.conform_batting(frame(spark, *rows)).collect()
    assert (row["career_start_year"], row["matches"]) == (None, 9)


def test_bowling(spark):
    rows = [
        ("Wim Ash (East/QP)", "1952-1966", "74", "139", "15020", "6105", "288", "6-41", "21.2", "2.44", "52.1", "13", "9"),
        ("Xan Bly (QP)", "1958-1959", "3", "-", "-", "-", "-", "-", "-", "-", "-", "-", "-"),
        ("Yva Cole (QP)", "1958-1959", "3", "2", "30", "25", "0", "0/25", "-", "5.0", "-", "0", "0"),
    ]
    out = conform.conform_bowling(spark.createDataFrame(rows, BRONZE_BOWLING))
    assert out.schema.simpleString() == SILVER_BOWLING.simpleString()
    (row,) = out.collect()
    assert (row["player"], row["country_tag"], row["wickets"]) == ("wim ash", "east/qp", 288)
    assert (row["best_bowling_innings"], row["four_wicket_hauls"]) == ("6-41", 13)


def test_bowling_without_span_keeps_the_schema(spark):
    out = conform.conform_bowling(spark.createDataFrame([("A (X)", "3")], "Player string, Wkts string"))
    assert out.columns == [f.name for f in SILVER_BOWLING.fields]
    assert out.first()["career_start_year"] is None


def test_rows_without_a_player_are_dropped_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    frame(spark, MIXED, {**MIXED, "Player": None}).write.parquet(path)
    out = conform.conform_batting(spark.read.parquet(path))
    assert out.count() == 1
    assert "PushedFilters: [IsNotNull(Player)" in out._jdf.queryExecution().executedPlan().toString()


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, "x")], ["Unnamed: 0", "_c0", "_code", "a"])
    assert columns.drop_index_columns(df).columns == ["_code", "a"]
    assert columns.first_present(df, ["player", "a"]) == "a"
    with pytest.raises(KeyError):
        columns.first_present(df, ["player", "Player"])


def test_staging_keeps_the_earliest_career_and_newest_ingestion(spark):
    base = conform.conform_batting(
        frame(spark, *[{**MIXED, "Span": s, "Runs": r} for s, r in (("2005-2009", 1), ("1999-2003", 2), ("x", 3))])
    )
    days = [dt.date(2024, 6, 15), dt.date(2024, 6, 16)]
    silver = base.withColumn("ingestion_date", F.lit(days[0])).unionByName(
        base.withColumn("runs", F.col("runs") + 10).withColumn("ingestion_date", F.lit(days[1]))
    )
    (row,) = staging.stg_batting(silver).collect()
    assert (row["career_start_year"], row["runs"]) == (1999, 12)
    assert dict(staging.stg_batting(silver).dtypes)["runs"] == "int"
    assert staging.stg_batting(silver).columns == list(staging.BATTING_COLUMNS)


def test_weather_staging_options(spark):
    silver = spark.createDataFrame(
        [("1", None, 2.0, 3.0)], "match_id string, temp_max_c double, precip_mm double, rain_mm double"
    )
    assert tuple(staging.stg_weather(silver).first()) == ("1", 0.0, 2.0, 3.0)
    assert tuple(staging.stg_weather(silver, missing=None, rain=0.0).first()) == ("1", None, 2.0, 0.0)


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    deduped = dedupe_max(df, ["k"], "v")
    assert deduped.where("k = 0").first()["v"] == 999
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_integers_are_exact(spark):
    big = 9_007_199_254_740_993
    rows = [{**MIXED, "Player": "A", "Runs": str(big)}, {**MIXED, "Player": "B", "Runs": f" {big} "}, {**MIXED, "Player": "C", "Runs": "12.0"}]
    assert {r["player"]: r["runs"] for r in conform.conform_batting(frame(spark, *rows)).collect()} == {"a": big, "b": big, "c": 12}
    (row,) = conform.conform_batting(frame(spark, {**MIXED, "Runs": big})).collect()
    assert row["runs"] == big
