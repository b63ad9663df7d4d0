"""Commits of several tables: what readers see, conflicts, dates and old folders."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import types as T

from pavilion.sources import commits

DAYS = [dt.date(2024, 6, 15 + i) for i in range(3)]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "commits")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n bigint")


def values(df):
    return sorted(r["n"] for r in df.collect())


def test_a_run_is_seen_whole_or_not_at_all(spark, root, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    with commits.Run(spark, root) as run:
        assert values(run.write(a, numbers(spark, 1, 2))) == [1, 2]
        with pytest.raises(LookupError):
            commits.read(spark, root, a)
        run.write(b, numbers(spark, 3))
        assert values(run.read(b)) == [3]
        assert run.publish() == 1
    with pytest.raises(ValueError, match="stop"), commits.Run(spark, root) as run:
        run.write(a, numbers(spark, 9))
        raise ValueError("stop")
    assert values(commits.read(spark, root, a)) == [1, 2] and values(commits.read(spark, root, b)) == [3]
    assert len(os.listdir(a)) == 1  # the folder of the failed run is gone


def test_dates_are_replaced_one_by_one(spark, root, tmp_path):
    table, schema = f"{tmp_path}/t", T.StructType([T.StructField("n", T.LongType())])
    for i, day in enumerate(DAYS):
        with commits.Run(spark, root) as run:
            run.write(table, numbers(spark, i), day)
            run.publish()
    with commits.Run(spark, root) as run:
        run.write(table, numbers(spark, 7, 8), DAYS[0])
        run.write(table, numbers(spark), DAYS[1])
        run.publish()
    rows = commits.read(spark, root, table, schema)
    assert sorted(map(tuple, rows.collect())) == [(2, DAYS[2]), (7, DAYS[0]), (8, DAYS[0])] and rows.columns == ["n", "ingestion_date"]
    assert values(commits.read(spark, root, table, dates=[DAYS[0]])) == [7, 8]
    assert values(commits.read(spark, root, table, schema, manifest=commits.published(spark, root, 3))) == [0, 1, 2]
    with pytest.raises(LookupError):
        commits.read(spark, root, table, dates=[dt.date(2020, 1, 1)])


def test_the_second_of_two_runs_fails(spark, root, tmp_path):
    table = f"{tmp_path}/t"
    with commits.Run(spark, root) as first, commits.Run(spark, root) as second:
        first.write(table, numbers(spark, 1))
        second.write(table, numbers(spark, 2))
        second.publish()
        with pytest.raises(commits.ConflictError):
            first.publish()
    assert values(commits.read(spark, root, table)) == [2] and commits.versions(spark, root) == [1]
    assert [f for f in os.listdir(root) if not f.endswith((".json", ".crc"))] == []


def test_old_folders_expire(spark, root, tmp_path):
    table, other = f"{tmp_path}/t", f"{tmp_path}/o"
    for i in range(4):
        with commits.Run(spark, root) as run:
            run.write(table, numbers(spark, i))
            if i == 0:
                run.write(other, numbers(spark, 5))
            run.publish()
    assert len(commits.expire(spark, root, keep=2)) == 2
    assert commits.versions(spark, root) == [3, 4] and len(os.listdir(table)) == 2
    assert values(commits.read(spark, root, table)) == [3] and values(commits.read(spark, root, other)) == [5]


def test_split_of_nothing(spark, root, tmp_path):
    table, bad = f"{tmp_path}/t", f"{tmp_path}/bad"
    schema = T.StructType([T.StructField("n", T.LongType())])
    with commits.Run(spark, root) as run:
        run.write_split(table, bad, numbers(spark), [], DAYS[0])
        run.publish()
    assert commits.read(spark, root, table, schema).count() == 0 and commits.read(spark, root, bad, schema).count() == 0
    assert commits.read(spark, root, bad, schema).columns == ["n", "reasons", "ingestion_date"]
