"""Registered text queries against their SQL, or against plain loops where SQL cannot say it."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pavilion.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == ""


def test_mixture_over_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op2_block_mixture"](spark, FOLDER).collect()}
    assert {d["doc_id"]: len(brute.words(d["text"])) for d in docs} == {k: r["size"] for k, r in got.items()}
    for own in brute.groups((d["source"], got[d["doc_id"]]) for d in docs).values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1 and all(r["taken"] <= 3 * r["size"] for r in own)


def test_languages_of_the_table(spark):
    docs = {d["doc_id"]: d["lang"] for d in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op3_string_kernel_language"](spark, FOLDER).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_shards_of_the_table(spark):
    got = QUERIES["op6_hilbert_shards"](spark, FOLDER).collect()
    slots = brute.groups((r["shard"], r["slot"]) for r in got)
    assert sorted(slots) == list(range(24)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == sorted(brute.shards([tuple(d) for d in docs], 24))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    rows, columns = docs.collect(), docs.columns
    texts = [(r["doc_id"], r["text"]) for r in rows]
    good = {r[0] for r in brute.quality(texts) if r[-1]}
    texts = [t for t in texts if t[0] in good]
    single = {r[0] for r in brute.near_duplicates(texts, 5) if r[-1]}
    texts = [t for t in texts if t[0] in single]
    clean = {r[0] for r in brute.benchmark_hits(texts, items) if not r[-1]}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(docs)
        assert docs.columns[: len(columns)] == columns
    assert [{r[0] for r in d.select("doc_id").collect()} for d in kept[:3]] == [good, single, clean]
    assert kept[3].count() == kept[4].count() and {r[0] for r in kept[3].select("doc_id").collect()} <= clean


def test_stages_of_messy_rows(spark, messy):
    """Frames that read no files, repeated rows, null ids, and columns of the names that stages add."""
    rows = [(i, t, "en" if n % 2 else None, f"s{n % 3}" if n % 5 else None, n) for n, (i, t) in enumerate([*messy, *messy])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"shard": F.lit("x"), "size": F.lit(1)})
    texts = [(r[0], r[1]) for r in rows]
    kept = corpus_pipeline.near_dedup(spark, docs, FOLDER)
    expected = {(d, t) for (d, t), r in zip(texts, brute.near_duplicates(texts, 5), strict=True) if r[-1]}
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(found) == len(set(found)) and set(found) == expected and kept.columns == docs.columns
    mixed = corpus_pipeline.mix(spark, docs, FOLDER)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert all(r["n_chars"] == len(r["text"]) and r["text"] for r in mixed.collect())
    placed = corpus_pipeline.shard(spark, docs, FOLDER)
    assert placed.count() == len(rows) and placed.columns.count("shard") == placed.columns.count("size") == 1
    slots = brute.groups((r["shard"], r["slot"]) for r in placed.collect())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_workers_need_no_package(tmp_path):
    """All queries in a fresh process whose workers find neither this repository nor its package."""
    root = str(Path(__file__).resolve().parents[2])
    code = f"""
import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pavilion.session import build_session
spark = build_session("alone", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
spark.sparkContext.setLogLevel("OFF")
for name in sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline"):
    print(name, entry.queries()[name](spark, {FOLDER!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len([x for x in done.stdout.splitlines() if x.split()[-1].isdigit()]) == 14


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        assert found.count() == 0
