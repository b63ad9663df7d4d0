"""Gates, table tests, contracts and quarantine."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from pavilion.config import GateRule
from pavilion.operators import quality
from pavilion.operators.quality import FieldRule, QualityGateFailure, TableTest
from pavilion.plans import contracts
from pavilion.schemas import SILVER_BATTING, SILVER_BOWLING
from pavilion.workload import QUERIES


def batting(spark, n=60):
    rows = spark.range(n).selectExpr(
        "concat('p', id) as player", "'ind' as country_tag", "2000L as career_start_year",
        "2010L as career_end_year", "id as matches", "id as innings", "1L as not_outs", "id * 10 as runs",
        "id as balls_faced", "0L as hundreds", "1L as fifties", "0L as ducks", "10.5D as average",
        "80.0D as strike_rate", "bigint(null) as fours", "false as fours_is_lower_bound",
        "bigint(null) as sixes", "false as sixes_is_lower_bound", "bigint(null) as high_score",
        "false as high_score_not_out",
    )
    assert rows.schema.simpleString() == SILVER_BATTING.simpleString()
    return rows


def rules(min_rows=50):
    return {
        "batting": (contracts.batting_contract(), GateRule(min_rows)),
        "bowling": (contracts.bowling_contract(), GateRule(min_rows)),
    }


def check(df, **options):
    quality.validate_table(df, "batting", rules(**options))


def test_clean_table_passes(spark):
    check(batting(spark))


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("runs", "-100L", "runs ge"),
        ("runs", "99999L", "runs le"),
        ("player", "''", "player min_length"),
        ("career_start_year", "2020L", "career_span_valid"),
        ("career_end_year", "1700L", "career_end_year ge"),
        ("average", "double('NaN')", "average ge"),
        ("strike_rate", "501D", "strike_rate le"),
    ],
)
def test_one_bad_cell_fails(spark, column, value, message):
    bad = batting(spark).withColumn(column, F.expr(f"if(player = 'p7', {value}, {column})"))
    with pytest.raises(QualityGateFailure, match=message):
        check(bad)


def test_one_null_player_fails_in_the_schema_layer(spark):
    bad = batting(spark).withColumn("player", F.expr("if(player = 'p7', null, player)"))
    with pytest.raises(QualityGateFailure, match="schema player not_null"):
        check(bad)


def test_infinite_average_passes(spark):
    check(batting(spark).withColumn("average", F.lit(float("inf"))))


def test_layers_stop_at_the_first_failure(spark):
    bad = batting(spark, 10).withColumn("runs", F.lit(-1).cast("bigint"))
    with pytest.raises(QualityGateFailure) as failure:
        check(bad)
    assert "row_count" in str(failure.value) and "runs" not in str(failure.value)
    gappy = batting(spark).withColumn("runs", F.lit(-1).cast("bigint")).withColumn(
        "innings", F.lit(None).cast("bigint")
    )
    with pytest.raises(QualityGateFailure) as failure:
        check(gappy)
    assert "innings" in str(failure.value) and "runs" not in str(failure.value)


def test_empty_table_fails_on_rows(spark):
    with pytest.raises(QualityGateFailure, match="row_count"):
        check(batting(spark, 0))
    empty = quality.null_ratio_gate(batting(spark, 0), 0.5)
    assert {r["status"] for r in empty.collect()} == {"empty"}


def test_null_ratios_both_sides(spark):
    df = spark.range(100).selectExpr("if(id < 5, null, id) as a", "if(id < 18, null, id) as b", "null as fours", "null as other")
    status = {r["column_name"]: r["status"] for r in quality.null_ratio_gate(df, 0.1, ["fours"]).collect()}
    assert status == {"a": "ok", "b": "failed", "fours": "all_null_allowed", "other": "failed"}


def test_types_are_not_coerced(spark):
    wrong = batting(spark).withColumn("runs", F.col("runs").cast("int")).drop("fifties")
    with pytest.raises(QualityGateFailure) as failure:
        check(wrong.withColumn("extra", F.lit(1)))
    assert "runs type" in str(failure.value) and "fifties type" in str(failure.value)
    assert "extra" not in str(failure.value)


def test_unknown_table(spark):
    with pytest.raises(ValueError, match="no quality contract"):
        quality.validate_table(batting(spark), "not_a_table", rules())


def test_run_gate_names_every_failing_table(spark):
    bowling = spark.createDataFrame([], SILVER_BOWLING)
    with pytest.raises(QualityGateFailure, match="2 table") as failure:
        quality.run_gate({"batting": batting(spark, 1), "bowling": bowling}, rules())
    assert "batting: row_count" in str(failure.value) and "bowling: row_count" in str(failure.value)
    quality.run_gate({"batting": batting(spark)}, rules())


def test_fixture_threshold():
    rule = GateRule(2000, fixture_min_rows=50)
    assert (rule.rows_needed(), rule.rows_needed(fixtures=True), GateRule(9).rows_needed(True)) == (2000, 50, 9)
    with pytest.raises(ValueError, match="max_null_ratio"):
        GateRule(1, max_null_ratio=1.5)


def test_a_report_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "silver")
    batting(spark).write.parquet(path)
    report = quality.gate_report(spark.read.parquet(path), *rules()["batting"])
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_table_tests(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", None), (2, "z", 50), (None, None, 7), (None, "a", 9)], "k int, kind string, v int"
    )
    tests = [
        TableTest("t", "k", "unique"),
        TableTest("t", "k", "not_null"),
        TableTest("t", "kind", "accepted_values", values=("a", "b")),
        TableTest("t", "v", "accepted_range", low=6, high=40),
        TableTest("t", "v", "accepted_range", low=6, where="kind = 'z'"),
    ]
    report = quality.run_tests({"t": df}, tests).collect()
    assert sorted((r["column_name"], r["check_name"], r["violations"]) for r in report) == [
        ("k", "not_null", 2),
        ("k", "unique", 1),
        ("kind", "accepted_values", 1),
        ("v", "accepted_range", 0),
        ("v", "accepted_range", 2),
    ]
    with pytest.raises(QualityGateFailure, match="t.k: unique: 1"):
        quality.require_tests({"t": df}, tests)
    assert [tuple(r) for r in quality.duplicate_keys(df, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.unaccepted_values(df, "kind", ["a", "b"]).collect()] == [("z", 1)]
    assert quality.out_of_range(df, "v", 6, 40).count() == 2


def test_twenty_nine_tests_are_declared():
    assert len(contracts.source_tests()) == 4
    assert len(contracts.model_tests()) == 25


def test_transaction_contract(spark):
    now = dt.datetime(2024, 6, 15)
    rows = [("t1", "u", 0.01, now), ("t1", None, 0.0, now), (None, "u", 5.0, None), ("t2", "u", None, now)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, amount double, timestamp timestamp")
    report = quality.contract_report(df, contracts.transaction_contract())
    found = {(r["column_name"], r["check_name"]): r["violations"] for r in report.collect()}
    assert found[("transaction_id", "unique")] == found[("transaction_id", "not_null")] == 1
    assert found[("amount", "ge")] == found[("amount", "not_null")] == found[("user_id", "not_null")] == 1
    assert all(v == 0 for (_, check), v in found.items() if check == "type")
    wrong = df.withColumn("amount", F.col("amount").cast("int"))
    report = quality.contract_report(wrong, contracts.transaction_contract())
    assert {r["column_name"] for r in report.where("check_name = 'type' and violations = 1").collect()} == {"amount"}


def test_quarantine_splits_the_input(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)], "player string, runs int")
    rules_ = (FieldRule("player", required=True), FieldRule("runs", T.IntegerType(), required=True))
    checks = quality.contract_checks(quality.Contract("t", rules_), df)
    valid, invalid = quality.quarantine(df, checks)
    assert [tuple(r) for r in valid.collect()] == [("a", 1)]
    reasons = sorted(",".join(r["reasons"]) for r in invalid.collect())
    assert reasons == ["player:not_null", "player:not_null,runs:not_null", "runs:not_null"]
    assert valid.unionByName(invalid.drop("reasons")).exceptAll(df).isEmpty()


def test_an_empty_table_fails_its_gate_with_a_message(spark):
    nothing = {"batting": batting(spark).limit(0), "bowling": batting(spark).limit(0)}
    loose = {name: (contract, GateRule(0)) for name, (contract, _) in rules().items()}
    with pytest.raises(QualityGateFailure, match="observed nothing") as failure:
        quality.run_gate(nothing, loose)
    assert "2 table(s)" in str(failure.value)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (float("inf"), "c")], "x double, y string")
    assert {r["column_name"]: r["null_ratio"] for r in quality.null_ratios(df).collect()} == {"x": 0.5, "y": 0.25}


def test_contract_of_missing_columns(spark):
    contract = quality.Contract("t", (FieldRule("k", T.LongType(), required=True, unique=True), FieldRule("v", ge=0), FieldRule("w", T.StringType())))
    for rows in (spark.range(3).select(F.col("id").cast("string").alias("w")), spark.range(0).select(F.col("id").alias("w"))):
        found = {(r["column_name"], r["check_name"]): r["violations"] for r in quality.contract_report(rows, contract).collect()}
        wrong = int(dict(rows.dtypes)["w"] != "string")
        assert found == {("k", "type"): 1, ("w", "type"): wrong, ("v", "missing"): 1}
    full = spark.createDataFrame([(1, 2, "a"), (1, -2, None)], "k bigint, v int, w string")
    found = {(r["column_name"], r["check_name"]): r["violations"] for r in quality.contract_report(full, contract).collect()}
    assert found == {("k", "not_null"): 0, ("v", "ge"): 1, ("k", "type"): 0, ("w", "type"): 0, ("k", "unique"): 1}
    with pytest.raises(ValueError, match="no rules"):
        quality.contract_report(full, quality.Contract("t", ()))


def test_references_and_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (9, "b")], "k int, n string")
    dims = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    tests = [TableTest("f", "k", "references", to=("d", "id")), TableTest("f", "n", "unique"), TableTest("f", "k", "unique")]
    found = {(r["column_name"], r["check_name"]): r["violations"] for r in quality.run_tests({"f": facts, "d": dims}, tests).collect()}
    assert found == {("k", "references"): 1, ("n", "unique"): 1, ("k", "unique"): 0}
    assert [r["k"] for r in quality.orphans(facts, "k", dims, "id").collect()] == [9]


def test_repeated_match_is_reported(spark, tmp_path):
    tables = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{tables}/orders.parquet")
    orders.union(orders.where("o_orderkey < 3")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{tables}/lineitem.parquet").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = QUERIES["ball_tests"](spark, str(tmp_path)).where("table_name = 'matches'").collect()
    assert {(r["column_name"], r["check_name"]): r["violations"] for r in rows} == {("match_id", "not_null"): 0, ("match_id", "unique"): 3}
