"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pavilion.workload import ORACLES, QUERIES, ingest, registry
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "rank"


# Read or write queries run jobs while they are built; their plans are covered by other tests.
LAZY = [n for n in QUERIES if not n.startswith(("scan_", "write_", "read_", "mart_", "test_report", "row_audit", "refit", "land_", "corrupt_", "loose_", "commit_", "quarantine_one", "infer_"))]


@pytest.mark.parametrize("name", ["salted_join", "hot_key_join"])
def test_skewed_joins_are_shuffled(spark, name):
    """The queries show salting at work: their last join is no broadcast."""
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan


def test_entry_has_the_queries_of_the_library():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_all_pairs_join_or_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["test_range"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,A)" in plan and "l_extendedprice" not in plan


@pytest.mark.parametrize("name", ["html_headers_and_references", "html_spans_and_nested", "page_drift_mixed"])
def test_pages_are_parsed_by_many_tasks(spark, name):
    """The bytes shuffled are a few per page, so Spark merged the pages into one task."""
    tasks = QUERIES[name](spark, FOLDER).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 8


def test_documents_are_packed_by_rows(spark, monkeypatch, tmp_path):
    """A task holds the directory of its archive till the end, so the rows of a task are bounded."""
    monkeypatch.setattr(registry, "_ROWS_PER_TASK", 100)
    src = registry.Source(spark, FOLDER)
    ingest.write_archives(src.docs, str(tmp_path))
    held = [len(zipfile.ZipFile(path).namelist()) - 1 for path in tmp_path.glob("*.zip")]
    assert sum(held) == src["orders"].count() and len(held) == 15 and max(held) < 200


def test_refit_sql_tells_signs_and_counts(spark):
    folder = "/root/testdata/sf0.001"
    found = spark.createDataFrame(QUERIES["refit_weights"](spark, folder).collect(), "feature string, weight double, undefined bigint")
    connection, sql = connect(folder), ORACLES["refit_weights"]
    assert compare(found, connection, sql) == ""
    assert compare(found.withColumn("weight", -found["weight"]), connection, sql) != ""
    assert compare(found.withColumn("undefined", found["undefined"] + 1), connection, sql) != ""
