"""Profiles of parts against a scan of the whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from pavilion.config import GateRule
from pavilion.operators import profiles, quality
from pavilion.operators.quality import Contract, FieldRule

CONTRACT = Contract(
    "t",
    (FieldRule("id", T.LongType(), required=True, ge=0), FieldRule("x", T.DoubleType(), le=50.0), FieldRule("name", T.StringType(), min_length=2), FieldRule("gone", T.LongType())),
    may_be_all_null=frozenset({"nothing"}),
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 6000).selectExpr(
        "if(id % 100 = 7, null, id - 3) as id", "if(id % 9 = 0, double('nan'), id / 100.0D) as x", "if(id % 4 = 0, 'a', concat('n', id % 300)) as name",
        "string(null) as nothing", "date_add(date'2024-01-01', cast(id % 40 as int)) as day", "array(id) as list", "id % 3 as part",
    )


@pytest.mark.parametrize("rule", [GateRule(10, max_null_ratio=0.05), GateRule(7000, max_null_ratio=1.0)])
def test_merged_profiles_are_the_scan(rows, rule):
    parts = [profiles.profile(rows.where(F.col("part") == i).drop("part"), CONTRACT) for i in range(4)]  # the last one is empty
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    whole = rows.drop("part")
    got = profiles.profile_report(profiles.merged(union), whole.schema, CONTRACT, rule)
    assert sorted(map(str, got.collect())) == sorted(map(str, quality.gate_report(whole, CONTRACT, rule).collect()))
    merged = {r["column_name"]: r for r in profiles.merged(union).where("check_name is null").collect()}
    direct = {r["column_name"]: r for r in profiles.profile(whole, CONTRACT).where("check_name is null").collect()}
    for name, row in direct.items():
        assert (merged[name]["low"], merged[name]["high"], merged[name]["amount"]) == (row["low"], row["high"], row["amount"])
    assert merged["id"]["low"]["whole"] == -3 and merged["day"]["high"]["text"] == "2024-02-09" and merged["nothing"]["low"] is None
    assert merged["x"]["high"]["number"] == 59.99


def test_repeated_values_show_in_a_profile(rows):
    found = {r["column_name"]: r for r in profiles.uniqueness(profiles.profile(rows, CONTRACT)).collect()}
    assert found["name"]["repeated"] and found["day"]["repeated"] and not found["id"]["repeated"]
    assert "list" not in found and abs(found["id"]["about_distinct"] - 5940) < 300


def test_a_profile_is_one_scan(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    plan = profiles.profile(spark.read.parquet(path), CONTRACT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
