"""Global rank against a plain window, top lists and pages."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from pavilion.operators import rank
from pavilion.plans import serving


def order():
    return [F.col("s").desc_nulls_last(), F.col("k").asc_nulls_last()]


@pytest.fixture(scope="module")
def scores(spark):
    """A third of the rows shares one score, some have none."""
    return spark.range(5000).selectExpr(
        "case when id % 3 = 0 then 50.0D when id % 97 = 1 then null else (id * 7919 % 1000) / 10.0D end as s",
        "concat('p', lpad(id, 6, '0')) as k",
    )


def test_global_rank_is_the_window_rank(scores):
    expected = scores.select(F.row_number().over(Window.orderBy(*order())).cast("bigint").alias("rank"), "s", "k")
    actual = rank.global_rank(scores.repartition(6), *order())
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_global_rank_spreads_equal_scores(spark, scores):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        slices = rank.sorted_slices(scores, *order()).where("s = 50.0D")
        sizes = [r["count"] for r in slices.groupBy("__slice").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 2 and max(sizes) < 1000


def test_global_rank_windows_slices_only(scores):
    plan = rank.global_rank(scores, *order())._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Aggregate" in window  # the window reads counts per slice, not rows


def test_global_rank_of_nothing(scores):
    assert rank.global_rank(scores.where("s < -1"), *order()).count() == 0


def test_top_ranked(scores):
    top = rank.top_ranked(scores, *order(), limit=30)
    rows = top.collect()
    assert [r["rank"] for r in rows] == list(range(1, 31))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="limit"):
        rank.top_ranked(scores, *order(), limit=0)
    for bad in (0, 201):
        with pytest.raises(ValueError, match="limit"):
            serving.rankings_batsmen(scores, bad)


def test_pages_cover_the_frame(scores):
    whole = [r["k"] for r in scores.orderBy("k").collect()]
    pages = [rank.page(scores, [F.col("k")], 2000, o).collect() for o in (0, 2000, 4000, 6000)]
    assert [r["k"] for p in pages for r in p] == whole
    assert {r["total"] for p in pages for r in p} == {5000}
    for limit, offset in ((0, 0), (5, -1)):
        with pytest.raises(ValueError, match="limit"):
            rank.page(scores, [F.col("k")], limit, offset)


def test_walking_through_pages(spark):
    rows = [(a, b) for a in ("x", "y", None) for b in (1, 2, 3, None)]
    df = spark.createDataFrame(rows, "a string, b int")
    seen, last = [], None
    while True:
        page = df.orderBy("a").where("a = 'x' and b = 1") if last is None else rank.page_after(df, ["a", "b"], last, 5)
        found = [tuple(r) for r in page.collect()]
        if not found:
            break
        seen, last = seen + found, found[-1]
    assert seen == rows


def test_newest(spark):
    names = spark.createDataFrame([(n,) for n in ("3.json", "1.json", "2.json")], "n string")
    assert [r["n"] for r in rank.newest(names, "n", 2).collect()] == ["3.json", "2.json"]


def test_stored_ranks(spark, scores, tmp_path):
    """Pages of a written table: right rows, no sort, and no more files than hold them."""
    path = str(tmp_path / "ranked")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rank.write_ranked(scores.repartition(6), order(), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    expected = [(r["rank"], r["k"]) for r in rank.global_rank(scores, *order()).orderBy("rank").select("rank", "k").collect()]
    n_files = len(spark.read.parquet(f"{path}/rows").inputFiles())
    assert n_files >= 6
    for limit, offset in ((10, 0), (10, 2500), (1200, 1000), (500, 4990), (5, 5000), (9000, 0)):
        found = rank.ranked_page(spark, path, limit, offset)
        rows = sorted((r["rank"], r["k"]) for r in found.collect())
        assert rows == expected[offset : offset + limit]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan
        if limit == 10:
            assert 1 <= len(found.inputFiles()) <= 2
    assert rank.ranked_page(spark, path, 10, 0).first()["total"] == 5000
    with pytest.raises(ValueError, match="limit"):
        rank.ranked_page(spark, path, 0, 0)


def test_stored_ranks_of_nothing(spark, scores, tmp_path):
    rank.write_ranked(scores.where("s < -1"), order(), str(tmp_path / "none"))
    assert rank.ranked_page(spark, str(tmp_path / "none"), 5, 0).collect() == []
