"""Salted joins equal the plain join; null-safe full outer join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pavilion.operators import joins
from pavilion.plans import marts


def same_rows(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def sides(spark):
    """A left side with a hot key, a hot group of identical rows and null keys."""
    left = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('k', id % 40) end as k",
        "if(id % 3 = 0, 7, id) as v",
    )
    right = spark.range(60).selectExpr("if(id < 2, 'hot', concat('k', id)) as k", "id as w")
    return left, right.unionByName(right.where("w < 5").withColumn("k", F.lit(None).cast("string")))


@pytest.mark.parametrize("buckets", [1, 2, 10])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_is_the_plain_join(sides, buckets, how):
    left, right = sides
    assert same_rows(joins.salted_join(left, right, "k", buckets, how=how), left.join(right, "k", how))


@pytest.mark.parametrize("rows_per_task", [1, 100, 10_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_is_the_plain_join(sides, rows_per_task, how):
    left, right = sides
    joined = joins.hot_key_join(left, right, "k", rows_per_task, how=how)
    assert same_rows(joined, left.join(right, "k", how))


def test_only_hot_keys_get_salts(sides):
    left, _ = sides
    assert [tuple(r) for r in joins.hot_keys(left, "k", 300).collect()] == [("hot", 4)]


def test_all_hot_keys_are_salted_however_many(spark):
    left = spark.range(36_000).selectExpr("id % 12000 as k", "id as v")
    assert joins.hot_keys(left, "k", 2).count() == 12_000


def test_null_keys_are_spread(sides):
    left, right = sides
    nulls = joins.salted_join(left, right, "k", 4).where("k is null")
    assert nulls.count() == left.where("k is null").count()


@pytest.mark.parametrize("join", [joins.salted_join, joins.hot_key_join])
def test_the_strategy_can_be_named(sides, join):
    left, right = sides
    plan = join(left, right, "k", 100, hint="merge")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan


def test_row_id_spreads_identical_rows(spark, tmp_path):
    from pavilion.sources.tables import read_with_row_id

    path = str(tmp_path / "copies")
    spark.range(1000).selectExpr("'hot' as k").coalesce(1).write.parquet(path)
    copies = read_with_row_id(spark, path)
    salts = copies.select(F.pmod(joins._row_hash(copies, ["row_id"]), F.lit(10)).alias("s"))
    sizes = [r["count"] for r in salts.groupBy("s").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    again = read_with_row_id(spark, path)
    assert same_rows(copies, again)


def test_salting_bounds_the_largest_task(spark):
    left = spark.range(10_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    hot = joins.hot_keys(left, "k", 500)
    assert [tuple(r) for r in hot.collect()] == [(0, 7)]


def test_replicate_and_prefix(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "k"])
    assert [r["salt"] for r in joins.replicate(df, 3).collect()] == [0, 1, 2]
    assert joins.prefixed(df, "bowl_", ["k"]).columns == ["bowl_a", "k"]
    assert "Cartesian" not in joins.replicate(df, 3)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [None, 4])
def test_wide_player_stats(spark, buckets):
    """One name holds most batting rows; a name of one side only keeps its row or leaves none."""
    batting = spark.range(200).selectExpr("if(id % 4 < 3, 'Odile Quay (TT)', concat('Solo ', id)) as player", "id as score")
    bowling = spark.createDataFrame([("ODILE QUAY", 17, 2.5), ("nobody (ZZ)", 3, 9.0)], "player string, scalps int, rate double")
    out = marts.player_stats_wide(batting, bowling, buckets)
    assert out.columns == ["player", "score", "bowl_player", "bowl_scalps", "bowl_rate"]
    assert out.count() == 200
    assert out.where("bowl_scalps = 17 and bowl_rate = 2.5").count() == 150
    assert out.where("bowl_player is null").count() == 50


def test_wide_player_stats_by_day(spark):
    days = [f"2024-03-0{d}" for d in (1, 2, 3)]
    batting = spark.createDataFrame([("Pia", d, i) for i, d in enumerate(days)] + [(None, days[0], 9)], "player string, day string, score int")
    bowling = spark.createDataFrame([("pia (QQ)", d, i * 10) for i, d in enumerate(days[:2])], "player string, day string, scalps int")
    out = marts.player_stats_wide(batting, bowling, by="day")
    rows = {r["score"]: r["bowl_scalps"] for r in out.collect()}
    assert rows == {0: 0, 1: 10, 2: None, 9: None}


def test_full_outer_null_safe(spark):
    left = spark.createDataFrame([("a", 1, 10), ("b", None, 20), (None, None, 30)], "p string, y int, l int")
    right = spark.createDataFrame([("a", 2, 1), ("b", None, 2), (None, None, 3)], "p string, y int, r int")
    out = joins.full_outer_null_safe(left, right, ["p"], ["y"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", 1, 10, None), ("a", 2, None, 1), ("b", None, 20, 2), (None, None, 30, None), (None, None, None, 3)],
        key=str,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("rows_per_task", [40, 300, 2000])
def test_sketched_keys_are_the_counted_ones(sides, rows_per_task):
    left, _ = sides
    exact = left.where("k is not null").groupBy("k").count().where(F.col("count") > rows_per_task)
    salts = exact.select("k", F.ceil(F.col("count") / rows_per_task).cast("int").alias("__salts"))
    assert joins.frequent_keys(left, "k", rows_per_task) is not None
    assert same_rows(joins.hot_keys(left.repartition(7), "k", rows_per_task), salts)


def test_keys_are_not_shuffled_to_find_the_hot_ones(spark, tmp_path):
    """100,000 keys of one row, one of a third of all: a handful of rows is exchanged."""
    path = str(tmp_path / "keys")
    spark.range(0, 150_000, 1, 6).selectExpr("if(id % 3 = 0, 'hot', string(id)) as k").write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.hot_keys(spark.read.parquet(path), "k", 10_000)
        assert [tuple(r) for r in found.collect()] == [("hot", 5)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Exchange hashpartitioning(k") < plan.index("BroadcastHashJoin")  # the join cuts the rows first
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_that_no_sketch_takes_are_counted(spark, monkeypatch):
    left = spark.range(100).selectExpr("array(id % 3) as a", "id % 3 as k")
    assert joins.frequent_keys(left, "a", 10) is None
    monkeypatch.setattr(joins, "_SKETCH_MOST", 10)
    assert joins.frequent_keys(left, "k", 10) is None and joins.hot_keys(left, "k", 10).count() == 3
