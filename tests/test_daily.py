"""The daily job end to end on small tables, and the Gold models."""

from __future__ import annotations

import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavilion.config import GateRule, MartRule, RoleRule
from pavilion.operators.quality import Check, QualityGateFailure, TableTest
from pavilion.operators.reshape import distinct_values, unpivot_metrics
from pavilion.plans import daily, marts, refit, serving, staging
from pavilion.plans.contracts import batting_contract, bowling_contract
from pavilion.schemas import MATCH_DOCUMENT, WEATHER_DOCUMENT
from pavilion.session import materialize, shared_folder
from pavilion.sources import commits, tables
from pavilion.workload import models

DAY = dt.date(2024, 6, 15)


def contracts(min_rows):
    rule = GateRule(min_rows, max_null_ratio=1.0)
    return {"batting": (batting_contract(), rule), "bowling": (bowling_contract(), rule)}


@pytest.fixture
def layers(spark, tmp_path):
    """Bronze tables of 40 players, of whom every second one also bowls."""
    layers = daily.Layers(*(str(tmp_path / layer) for layer in ("bronze", "silver", "gold")))
    batting = spark.range(40).selectExpr(
        "concat('Player ', id, ' (IND)') as Player", "'2000-2010' as Span", "string(id + 10) as Mat",
        "'9' as Inns", "string(id * 100) as Runs", "'30.5' as Ave", "'80.1' as SR", "'12+' as `4s`",
    )
    bowling = spark.range(0, 40, 2).selectExpr(
        "concat('Player ', id, ' (IND)') as Player", "'2000-2010' as Span", "string(id + 10) as Mat",
        "'9' as Inns", "string(id * 4) as Wkts", "'20.5' as Ave", "'4.1' as Econ", "'30.0' as SR",
    )
    for name, frame in (("batting", batting), ("bowling", bowling)):
        tables.write_partition(frame, tables.table_path(layers.bronze, name), DAY)
    return layers


def documents(spark):
    """Three sound match documents and a broken one, with weather for two of them."""
    deliveries = [{"batter": "ann", "bowler": "ben", "runs": {"batter": 4, "extras": 0, "total": 4}},
                  {"batter": "ann", "bowler": "ben", "runs": {"batter": 0, "extras": 0, "total": 0},
                   "wickets": [{"kind": "run out", "player_out": "cal"}]}]
    texts = []
    for key, venue in (("1", "V"), ("2", "V"), ("3", None)):
        doc = {"info": {"dates": ["2024-06-15"], "venue": venue, "city": "Ulm", "teams": ["X", "Y"], "match_type": "T20"},
               "innings": [{"team": "X", "overs": [{"over": 0, "deliveries": deliveries}]}]}
        texts.append((key, json.dumps(doc)))
    texts.append(("4", texts[0][1][:40]))
    docs = tables.parsed_documents(spark.createDataFrame(texts, "match_id string, t string"), "t", MATCH_DOCUMENT, F.col("match_id"))
    days = [("1", 32.0, -0.0, 1.0), ("2", 32.0, 0.0, 2.0), ("9", 20.0, 9.0, 0.0)]
    daily_values = [(k, {"time": ["d"], "temperature_2m_max": [t], "precipitation_sum": [p], "rain_sum": [r]}) for k, t, p, r in days]
    weather = spark.createDataFrame([(k, json.dumps({"match_id": k, "daily": d})) for k, d in daily_values], "k string, t string")
    return docs, tables.parsed_documents(weather, "t", WEATHER_DOCUMENT)


def gold(spark, layers, name):
    return daily.published(spark, layers, f"{layers.gold}/{name}")


def test_daily_run(spark, layers):
    docs, weather = documents(spark)
    for _ in range(2):  # a second run of the same day changes nothing
        audits = daily.run_daily(spark, layers, DAY, contracts=contracts(10), documents=docs, weather=weather)
    assert [(a.table, a.rows_in, a.rows_out, a.quarantined) for a in audits] == [
        ("batting", 40, 40, 0), ("bowling", 20, 19, 0), ("matches", 4, 3, 1), ("weather", 3, 3, 0),
    ]
    dim = gold(spark, layers, "dim_player")
    assert dim.count() == dim.select("player").distinct().count() == 40
    assert {r["player_role"] for r in dim.select("player_role").collect()} == {"batsman", "all_rounder"}
    mart = gold(spark, layers, "mart_top_batsmen")
    assert sorted(r["rank"] for r in mart.collect()) == list(range(1, mart.count() + 1))
    best = serving.rankings_batsmen(mart, 3).collect()
    assert [r["player"] for r in best] == ["player 39", "player 38", "player 37"]
    bowlers = gold(spark, layers, "mart_top_bowlers")
    assert serving.rankings_bowlers(bowlers, 1).first()["primary_metric"] == 152
    wide = gold(spark, layers, "player_stats")
    assert wide.count() == 40 and wide.where("bowl_wickets is not null").count() == 19
    broken = daily.published(spark, layers, f"{layers.rejects}/matches").collect()
    assert [(r["match_id"], r["reasons"]) for r in broken] == [("4", ["document:json"])]
    fact = gold(spark, layers, "fact_ball_by_ball")
    assert fact.count() == 6 and fact.agg(F.sum("is_wicket")).first()[0] == 3
    # Minus zero and zero are one reading, and rain tells readings apart.
    readings = gold(spark, layers, "dim_weather")
    assert readings.count() == readings.select("weather_id").distinct().count() == 3
    known = fact.where("match_id <> '3'")
    assert known.join(readings, "weather_id", "left_semi").count() == known.count() == 4
    context = serving.player_context(fact, gold(spark, layers, "dim_player_source"), readings)
    assert [tuple(r) for r in context.collect()] == [("ann", None, 2.0, 6)]
    assert not [f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith("daily-")]


def test_gate_halts_before_silver(spark, layers):
    with pytest.raises(QualityGateFailure, match="row_count"):
        daily.run_daily(spark, layers, DAY, contracts=contracts(30))
    assert commits.published(spark, layers.commits) == commits.Manifest()
    assert not [f for _, _, files in os.walk(layers.silver) for f in files] and not os.path.exists(layers.gold)


def test_a_failed_test_leaves_the_tables_of_the_day_before(spark, layers, monkeypatch):
    daily.run_daily(spark, layers, DAY, contracts=contracts(10))
    before = {t: sorted(map(tuple, gold(spark, layers, t).collect()), key=str) for t in ("dim_player", "mart_top_batsmen", "player_stats")}
    root = tables.table_path(layers.bronze, "batting")
    more = tables.read_partition(spark, root, DAY).drop("ingestion_date").withColumn("Runs", F.lit("77"))
    tables.write_partition(materialize(more, "bronze"), root, DAY)
    strict = [TableTest("dim_player", "runs", "accepted_range", low=100)]
    monkeypatch.setattr(daily, "model_tests", lambda: strict)
    with pytest.raises(QualityGateFailure, match="dim_player.runs"):
        daily.run_daily(spark, layers, DAY, contracts=contracts(10))
    after = {t: sorted(map(tuple, gold(spark, layers, t).collect()), key=str) for t in before}
    assert before == after
    assert not [f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith("daily-")]


def test_rejected_rows_are_published_as_quarantine(spark, layers):
    root = tables.table_path(layers.bronze, "batting")
    rows = materialize(tables.read_partition(spark, root, DAY).drop("ingestion_date"), "bronze")
    bad = rows.limit(1).withColumns({"Player": F.lit("Too Many (IND)"), "Runs": F.lit("99999")})
    tables.write_partition(rows.unionByName(bad), root, DAY)
    audits = daily.run_daily(spark, layers, DAY, contracts=contracts(10))
    assert (audits[0].rows_in, audits[0].rows_out, audits[0].quarantined) == (41, 40, 1)
    (row,) = daily.published(spark, layers, f"{layers.rejects}/batting").collect()
    assert (row["player"], row["reasons"]) == ("too many", ["runs:le"])
    # The same day without the bad row empties the quarantine.
    tables.write_partition(rows, root, DAY)
    daily.run_daily(spark, layers, DAY, contracts=contracts(10))
    assert daily.published(spark, layers, f"{layers.rejects}/batting").count() == 0
    assert daily.silver_tables(spark, layers)["batting"].count() == 40


def contents(spark, layers):
    """All rows of all published tables, by name."""
    manifest = commits.published(spark, layers.commits)
    return {t: sorted(map(str, daily.published(spark, layers, t, manifest=manifest).collect())) for t in manifest.tables}


def repeated_match(spark, number):
    """Documents of which one match comes twice, in its matches or its weather."""
    frames = list(documents(spark))
    frames[number] = frames[number].unionByName(frames[number].where("match_id = '1'"))
    return frames


@pytest.mark.parametrize("number", [0, 1])
def test_a_repeated_match_changes_no_table(spark, layers, number):
    docs, weather = documents(spark)
    daily.run_daily(spark, layers, DAY, contracts=contracts(10), documents=docs, weather=weather)
    before = contents(spark, layers)
    assert {f"{layers.gold}/fact_ball_by_ball", f"{layers.silver}/balls", f"{layers.gold}/dim_player", f"{layers.rejects}/batting"} <= set(before)
    docs, weather = repeated_match(spark, number)
    with pytest.raises(QualityGateFailure, match="match_id: unique"):
        daily.run_daily(spark, layers, DAY, contracts=contracts(10), documents=docs, weather=weather)
    assert contents(spark, layers) == before


@pytest.mark.parametrize("failing", [9])
def test_a_run_that_dies_between_two_tables_changes_none(spark, layers, monkeypatch, failing):
    docs, weather = documents(spark)
    options = {"contracts": contracts(10), "documents": docs, "weather": weather}
    daily.run_daily(spark, layers, DAY, **options)
    before, count, write = contents(spark, layers), [0], commits.Run.write

    def dying(self, *args, **kw):
        count[0] += 1
        if count[0] == failing:
            raise OSError("the disk is gone")
        return write(self, *args, **kw)

    monkeypatch.setattr(commits.Run, "write", dying)
    with pytest.raises(OSError, match="gone"):
        daily.run_daily(spark, layers, DAY, **options)
    assert contents(spark, layers) == before and commits.versions(spark, layers.commits) == [1]
    monkeypatch.setattr(commits.Run, "write", write)
    daily.run_daily(spark, layers, DAY, **options)
    assert contents(spark, layers) == before and commits.versions(spark, layers.commits) == [1, 2]


def test_valid_and_rejected_rows_are_one_write(spark, layers):
    """The input is scanned once, and rows are counted in the same job."""
    checks = [Check("positive", "n", F.col("n") <= 0)]
    path = f"{layers.bronze}/numbers"
    spark.range(-2, 5).withColumnRenamed("id", "n").write.parquet(path)
    with commits.Run(spark, layers.commits) as run:
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("split", "split")
        run.write_split(f"{layers.silver}/n", f"{layers.rejects}/n", spark.read.parquet(path), checks, DAY)
        assert len(jobs.getJobIdsForGroup("split")) == 2  # the schema of the input, and the write
        spark.sparkContext.setJobGroup("other", "other")
        run.publish()
    assert sorted(r["n"] for r in daily.published(spark, layers, f"{layers.silver}/n").collect()) == [1, 2, 3, 4]
    bad = daily.published(spark, layers, f"{layers.rejects}/n").collect()
    assert sorted((r["n"], *r["reasons"]) for r in bad) == [(-2, "n:positive"), (-1, "n:positive"), (0, "n:positive")]


def test_days_meet_themselves_only(spark, layers):
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    for name in ("batting", "bowling"):
        root = tables.table_path(layers.bronze, name)
        day1 = materialize(tables.read_partition(spark, root, DAY).drop("ingestion_date"), "bronze")
        for day in days[1:]:
            tables.write_partition(day1, root, day)
    for day in days:
        daily.run_daily(spark, layers, day, contracts=contracts(10))
    assert daily.silver_tables(spark, layers)["batting"].count() == 120
    assert gold(spark, layers, "dim_player").count() == 40
    assert gold(spark, layers, "player_stats").count() == 120
    profiled = {r["column_name"]: r for r in daily.table_profile(spark, layers, "batting").where("check_name is null").collect()}
    assert profiled["player"]["n_rows"] == 120 and profiled["runs"]["high"]["whole"] == 3900


def test_ball_by_ball_without_partners(spark):
    matches = spark.createDataFrame([("1", "2024-06-15", "V", "Pune"), ("2", "2024-06-16", None, None)], "match_id string, match_date string, venue string, city string")
    weather = spark.createDataFrame([("1", 32.0, 0.0, 0.0), ("2", 20.0, 9.0, 1.0)], "match_id string, temp_max_c double, precip_mm double, rain_mm double")
    balls = spark.createDataFrame(
        [("1", "X", 0, "a", "b", 4, 0, 4, None, None), ("2", "X", 1, "b", "a", 6, 0, 6, None, None), ("9", "X", 1, "a", "b", 1, 0, 1, None, None)],
        "match_id string, batting_team string, over_num bigint, batter string, bowler string, runs_batter bigint, "
        "runs_extras bigint, runs_total bigint, wicket_kind string, player_out string",
    )
    fact = marts.fact_ball_by_ball(balls, matches, weather)
    players, readings = marts.dim_player_source(balls), marts.dim_weather(weather)
    assert marts.dim_venue(matches).count() == 1
    context = serving.player_context(fact, players, readings)
    assert sorted(map(tuple, context.collect())) == [("a", None, 4.0, 2), ("b", 6.0, None, 1)]
    only = serving.player_context(fact, players, readings, "B")
    assert [r["player"] for r in only.collect()] == ["b"]
    # A ball without match or weather still gets keys, those of nulls.
    lost = fact.where("match_id = '9'").first()
    assert lost["match_date"] is None and lost["venue_id"] and lost["weather_id"]


def test_duplicate_match_rows_multiply_as_in_two_joins(spark):
    matches = spark.createDataFrame([("1", "d", "V", "C"), ("1", "e", "V", "C")], "match_id string, match_date string, venue string, city string")
    weather = spark.createDataFrame([("1", 1.0, 2.0, 0.0), ("1", 3.0, 4.0, 0.0), ("5", 1.0, 1.0, 0.0)], "match_id string, temp_max_c double, precip_mm double, rain_mm double")
    balls = spark.createDataFrame(
        [("1", "X", 0, "a", "b", 4, 0, 4, None, None), ("5", "X", 0, "a", "b", 4, 0, 4, None, None)],
        "match_id string, batting_team string, over_num bigint, batter string, bowler string, runs_batter bigint, "
        "runs_extras bigint, runs_total bigint, wicket_kind string, player_out string",
    )
    fact = marts.fact_ball_by_ball(balls, matches, weather)
    assert fact.where("match_id = '1'").count() == 4
    assert fact.where("match_id = '5'").count() == 1


def test_a_hot_match_is_split(spark, tmp_path):
    """A third of the balls in one match: Spark splits that partition of the fact join."""
    balls = spark.range(0, 300_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', string(id % 5000)) as match_id", "'X' as batting_team", "id as over_num",
        "concat('P', id) as batter", "concat('B', id) as bowler", "1L as runs_batter", "0L as runs_extras",
        "1L as runs_total", "string(null) as wicket_kind", "string(null) as player_out",
    )
    matches = spark.range(5000).selectExpr("string(id) as match_id", "'d' as match_date", "'v' as venue", "'c' as city")
    weather = matches.selectExpr("match_id", "1.0D as temp_max_c", "2.0D as precip_mm", "0.0D as rain_mm")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = marts.fact_ball_by_ball(balls, matches, weather)
        assert fact.count() == 300_000
        fact.collect()
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dim_player_roles_and_fallbacks(spark):
    bat_columns = ", ".join(f"{c} {t}" for c, t in staging.BATTING_COLUMNS.items())
    bowl_columns = ", ".join(f"{c} {t}" for c, t in staging.BOWLING_COLUMNS.items())
    bat = spark.createDataFrame(
        [("a", "x", 2000, 2001, 25, 20, 1, 1000, 40.0, 900, 80.0, 2, 3, 0, 5, 6, 100, True),
         ("b", None, None, None, 30, 20, 1, 600, 40.0, 900, 80.0, 2, 3, 0, 5, 6, 100, True)], bat_columns,
    )
    bowl = spark.createDataFrame(
        [("b", "y", None, 2003, 31, 21, 900, 800, 60, 20.0, 4.0, 30.0, 1, 0, "5/10"),
         ("c", "z", 2002, 2004, 32, 22, 900, 800, 55, 20.0, 4.0, 30.0, 1, 0, "5/10"),
         ("a", "w", 1999, 2004, 33, 23, 900, 800, 9, 20.0, 4.0, 30.0, 1, 0, "5/10")], bowl_columns,
    )
    rows = {(r["player"], r["career_start_year"]): r for r in marts.dim_player(bat, bowl).collect()}
    assert len(rows) == 4  # 'a' twice: the start years differ
    merged = marts.joined_careers(bat, bowl, same_start=False)
    assert {r["player"]: r["career_start_year"] for r in merged.collect()} == {"a": 2000, "b": None, "c": 2002}
    assert sorted(merged.columns) == sorted(marts.joined_careers(bat, bowl).columns)
    both = rows[("b", None)]
    assert (both["player_role"], both["country_tag"], both["career_end_year"], both["matches"]) == ("all_rounder", "y", 2003, 30)
    assert both["pca_score"] == both["pca_batting_score"]
    assert rows[("c", 2002)]["player_role"] == "bowler"
    assert rows[("c", 2002)]["pca_score"] == rows[("c", 2002)]["pca_bowling_score"]
    assert rows[("a", 1999)]["player_role"] == "batsman"
    dim = marts.dim_player(bat, bowl)
    stored = {"mart_top_batsmen": marts.batsmen(dim, MartRule()), "mart_top_bowlers": marts.bowlers(dim, MartRule()), "none": dim.limit(0)}
    assert sorted(map(tuple, serving.mart_counts(stored).collect())) == [("mart_top_batsmen", 2), ("mart_top_bowlers", 2), ("none", 0)]
    eager = marts.dim_player(bat, bowl, RoleRule(min_wickets=1, min_runs=1))
    assert eager.where("player_role = 'bowler'").count() == 2


def test_long_facts(spark):
    wide = spark.createDataFrame([("a", 1, 2.5), ("b", None, 3.5)], "player string, x int, y double")
    long = unpivot_metrics(wide, ["player"], {"ex": "x", "why": "y"})
    assert sorted(map(tuple, long.collect())) == [("a", "ex", 1.0), ("a", "why", 2.5), ("b", "why", 3.5)]
    assert long._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    names = spark.createDataFrame([("a", "b", None), ("b", "c", "a")], "x string, y string, z string")
    assert sorted(r["n"] for r in distinct_values(names, ["x", "y", "z"], "n").collect()) == ["a", "b", "c"]


def test_refit_equals_the_eigenvector_of_the_correlations(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    values = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, v)) for v in values], "a double, b double, c double, d double")
    weights = {r["feature"]: r["weight"] for r in refit.refit_weights(df, list("abcd"), "b").collect()}
    vector = np.linalg.eigh(np.corrcoef(values.T))[1][:, -1]
    vector = vector if vector[1] > 0 else -vector
    assert np.allclose([weights[c] for c in "abcd"], vector, atol=1e-9)


def test_refit_finds_the_common_direction(spark):
    df = spark.range(500).selectExpr(
        "double(id) as a", "double(id) * 2 + (id * 7919 % 13) as b", "-double(id) + (id * 104729 % 17) as c",
        "if(id = 3, double('inf'), double(id)) as d",
    )
    weights = {r["feature"]: r["weight"] for r in refit.refit_weights(df, ["a", "b", "c", "d"], "a").collect()}
    assert all(abs(abs(w) - 0.5) < 0.01 for w in weights.values())
    assert weights["a"] > 0 and weights["b"] > 0 > weights["c"]
    undefined = {r["feature"]: r["undefined"] for r in refit.refit_weights(df, ["a", "b", "c", "d"], "a").collect()}
    assert undefined == {"a": 0, "b": 0, "c": 0, "d": 1}
