"""Readers, writers, archives, HTML pages and enrichment lists."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import tracemalloc
import zipfile

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pavilion import session
from pavilion.operators import quality
from pavilion.operators.reshape import flatten_balls, flatten_matches, flatten_weather
from pavilion.schemas import BRONZE_BATTING, GEOCODE_DOCUMENT, MATCH_DOCUMENT, WEATHER_DOCUMENT
from pavilion.sources import archives, enrich, html, infer, tables

DAY1, DAY2 = dt.date(2024, 6, 15), dt.date(2024, 6, 16)


def ball(batter, wickets=None, total=1):
    out = {"batter": batter, "bowler": "B", "runs": {"batter": total, "extras": 0, "total": total}}
    return out if wickets is None else {**out, "wickets": wickets}


def match(city="Pune", deliveries=()):
    info = {"dates": ["2024-06-15", "2024-06-16"], "venue": "V", "teams": ["X", "Y"], "match_type": "T20"}
    if city:
        info["city"] = city
    overs = [{"over": 0, "deliveries": list(deliveries)}, {"over": 1, "deliveries": []}]
    return {"info": info, "innings": [{"team": "X", "overs": overs}], "meta": {"unknown": 1}}


BALLS = [
    ball("a"),
    ball("b", []),
    ball("c", [{"kind": "bowled", "player_out": "c"}]),
    ball("d", [{"kind": "run out", "player_out": "d"}, {"kind": "second", "player_out": "e"}]),
]


# ------------------------------------------------------------------------ tables


def test_partition_path():
    assert tables.partition_path("bronze", "batting", DAY1) == "bronze/batting/ingestion_date=2024-06-15"
    today = dt.datetime.now(dt.UTC).date()
    assert tables.partition_path("silver/", "bowling").endswith(f"ingestion_date={today}")


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    for _ in range(2):
        tables.write_partition(df, root, DAY1)
    tables.write_partition(df.where("id < 3"), root, DAY2)
    tables.write_partition(df.where("id < 5"), root, DAY1)
    assert tables.read_table(spark, root).groupBy("ingestion_date").count().orderBy("ingestion_date").collect() == [
        (DAY1, 5),
        (DAY2, 3),
    ]
    one = tables.read_partition(spark, root, DAY2, df.schema)
    assert sorted(r["id"] for r in one.collect()) == [0, 1, 2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert "ReadSchema: struct<v:bigint>" in one.select("v")._jdf.queryExecution().executedPlan().toString()


def test_an_empty_run_empties_its_date(spark, tmp_path):
    root = str(tmp_path / "t")
    for day in (DAY1, DAY2):
        tables.write_partition(spark.range(10), root, day)
    tables.write_partition(spark.range(0), root, DAY1)
    schema = spark.range(0).schema
    assert tables.read_partition(spark, root, DAY1, schema).count() == 0
    assert tables.read_partition(spark, root, DAY2, schema).count() == 10


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.csv").write_text("Runs,Extra,Player\n5,x,Ada\n")
    row = tables.scan_csv(spark, str(tmp_path / "one"), BRONZE_BATTING).first()
    assert (row["Player"], row["Runs"], row["Span"]) == ("Ada", "5", None)
    assert tables.scan_csv(spark, str(tmp_path / "one"), BRONZE_BATTING).columns == BRONZE_BATTING.names
    (tmp_path / "one" / "b.csv").write_text("Player,Extra,Runs\nBea,x,6\n")
    with pytest.raises(Exception, match="CSV"):
        tables.scan_csv(spark, str(tmp_path / "one"), BRONZE_BATTING).collect()


def test_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    sizes = {}
    for size in (None, 64 << 10):
        root = str(tmp_path / f"t{size}")
        tables.write_partition(spark.range(200_000).coalesce(1).select(F.sha2(F.col("id").cast("string"), 256).alias("h")), root, DAY1, row_group_bytes=size)
        sizes[size] = pq.ParquetFile(glob.glob(f"{root}/*/*.parquet")[0]).num_row_groups
    assert sizes[None] < sizes[64 << 10]


def test_codecs(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_partition(spark.range(5), root, DAY1, compression="zstd", dictionary=False)
    assert glob.glob(f"{root}/*/*.zstd.parquet")
    with pytest.raises(ValueError, match="compression"):
        tables.write_partition(spark.range(5), root, DAY1, compression="lzo")


def test_full_refresh_keeps_the_table_on_empty_input(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_full_refresh(spark.range(4), path)
    nothing = spark.range(0)
    assert not tables.write_full_refresh(nothing.distinct(), path, given=nothing)
    assert spark.read.parquet(path).count() == 4
    assert tables.write_full_refresh(spark.range(3), path, given=spark.range(1))
    assert spark.read.parquet(path).count() == 3


def test_samples_and_csv(spark, tmp_path):
    (tmp_path / "batting_sample.csv").write_text("Unnamed: 0,,Player,Runs\n0,0,A One (X),5\n1,1,B,\n")
    sample = tables.scan_sample(spark, str(tmp_path), "batting")
    assert sample.columns == ["Player", "Runs"]
    assert [tuple(r) for r in sample.collect()] == [("A One (X)", "5"), ("B", None)]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.scan_sample(spark, str(tmp_path), "nothing")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.scan_csv(spark, str(tmp_path / "no.csv"), BRONZE_BATTING)


def test_audit_counts_in_the_same_job(spark, tmp_path):
    from pavilion.plans.daily import conform_audited

    raw = spark.createDataFrame([("A (X)", "5", "1"), ("A (X)", "5", "2"), ("B", "-", "1")], "Player string, Runs string, Mat string")
    audit = conform_audited(raw, "batting", str(tmp_path / "silver"), DAY1)
    assert (audit.rows_in, audit.rows_out, audit.dropped) == (3, 1, 2)


def test_shared_folder_follows_the_session(spark, monkeypatch):
    assert session.shared_folder(spark)
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")
    folder = session.new_folder(spark, "x")
    kept = session.materialize(spark.range(3), "t", folder)
    assert kept.count() == 3 and os.path.exists(folder.removeprefix("file:"))
    session.discard(spark, folder)
    assert not os.path.exists(folder.removeprefix("file:"))
    assert session.shuffle_partitions(100 << 40) == 204_800 and session.shuffle_partitions(1) == 200


# --------------------------------------------------------------------- documents


def test_loose_documents(spark, tmp_path):
    for key, doc in {"123": match(deliveries=BALLS), "77": match(city=None)}.items():
        (tmp_path / f"{key}.json").write_text(json.dumps(doc, indent=1))
    docs = tables.scan_json_docs(spark, f"{tmp_path}/*.json", MATCH_DOCUMENT)
    rows = {r["match_id"]: r for r in flatten_matches(docs).collect()}
    assert tuple(rows["123"]) == ("123", "2024-06-15", "V", "Pune", "X", "Y", "T20")
    assert rows["77"]["city"] is None
    balls = sorted(tuple(r) for r in flatten_balls(docs).collect())
    assert balls == [
        ("123", "X", 0, "a", "B", 1, 0, 1, None, None),
        ("123", "X", 0, "b", "B", 1, 0, 1, None, None),
        ("123", "X", 0, "c", "B", 1, 0, 1, "bowled", "c"),
        ("123", "X", 0, "d", "B", 1, 0, 1, "run out", "d"),
    ]


def test_a_batch_without_wickets_still_reads(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(match(deliveries=[ball("a")])))
    docs = tables.scan_json_docs(spark, f"{tmp_path}/*.json", MATCH_DOCUMENT)
    assert flatten_balls(docs).first()["wicket_kind"] is None


def test_archives_are_split_by_entry(spark, tmp_path):
    for part in range(2):
        with zipfile.ZipFile(tmp_path / f"a{part}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("README.txt", "no document")
            for i in range(40):
                method = zipfile.ZIP_STORED if i % 2 else zipfile.ZIP_DEFLATED
                doc = json.dumps(match(deliveries=BALLS[: i % 4]))
                archive.writestr(f"t20s/{part}{i:03d}.json", doc, method)
    (tmp_path / "notes.txt").write_text("not an archive")
    entries = archives.scan_zip_entries(spark, str(tmp_path), chunk_bytes=1000)
    tasks = entries.select(F.spark_partition_id().alias("p")).where("p >= 0").distinct().count()
    assert tasks > 2  # more tasks than archives
    docs = archives.scan_zip_json(spark, str(tmp_path), MATCH_DOCUMENT)
    assert sorted(r["match_id"] for r in docs.select("match_id").collect()) == sorted(
        f"{p}{i:03d}" for p in range(2) for i in range(40)
    )
    assert flatten_balls(docs).count() == 2 * sum(i % 4 for i in range(40))


def test_tasks_read_alike(spark, tmp_path):
    """Archives of one chunk each: hashed whole, some tasks would read several of them and others none."""
    for part in range(16):
        with zipfile.ZipFile(tmp_path / f"a{part}.zip", "w", zipfile.ZIP_STORED) as archive:
            for i in range(320):
                archive.writestr(f"{i:03d}.json", "0" * 65)  # 103 bytes each with the local header
    size = (tmp_path / "a0.zip").stat().st_size
    entries = archives.scan_zip_entries(spark, str(tmp_path), chunk_bytes=size)
    read = entries.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in read) == 16 * 320 and max(r["count"] for r in read) < 2 * 320


def test_damaged_archives_are_noticed(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    with zipfile.ZipFile(folder / "a%20b.zip", "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("1.json", json.dumps(match(city="Aachen")))
        archive.writestr("2.json", '{"info": {"city": "cut off')
    docs = archives.scan_zip_json(spark, str(folder), MATCH_DOCUMENT)
    sound, broken = quality.quarantine(docs, [quality.sound_document()])
    assert [r["info"]["city"] for r in sound.collect()] == ["Aachen"]
    assert [(r["match_id"], r["corrupt"]) for r in broken.collect()] == [("2", '{"info": {"city": "cut off')]
    path = folder / "a%20b.zip"
    path.write_bytes(path.read_bytes().replace(b"Aachen", b"Bachen"))
    with pytest.raises(Exception, match="checksum"):
        archives.scan_zip_json(spark, str(folder), MATCH_DOCUMENT).collect()


def test_broken_documents_are_kept_apart(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(match(), indent=2))
    (tmp_path / "2.json").write_text(json.dumps(match(), indent=2)[:80])
    docs = tables.scan_json_docs(spark, f"{tmp_path}/*.json", MATCH_DOCUMENT)
    assert {r["match_id"]: r["corrupt"] is None for r in docs.collect()} == {"1": True, "2": False}


def test_archive_listing_does_not_read_contents(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("1.json", "{}")
    plan = archives.scan_zip_entries(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Project")[-1].split("\n")[0]


def test_weather_documents(spark, tmp_path):
    docs = [
        {"match_id": "1", "daily": {"time": ["d"], "temperature_2m_max": [30.5], "precipitation_sum": [0.0], "rain_sum": [None]}},
        {"match_id": "2", "daily": {"time": [], "temperature_2m_max": [], "precipitation_sum": [], "rain_sum": []}},
        {"match_id": "3"},
    ]
    for doc in docs:
        (tmp_path / f"{doc['match_id']}.json").write_text(json.dumps(doc))
    frame = tables.scan_json_docs(spark, f"{tmp_path}/*.json", WEATHER_DOCUMENT, key=None)
    assert sorted(tuple(r) for r in flatten_weather(frame).collect()) == [
        ("1", "d", 30.5, 0.0, None),
        ("2", None, None, None, None),
        ("3", None, None, None, None),
    ]
    tables.land_json(enrich.keyed_payload(frame.select("daily", "match_id")), str(tmp_path / "landed"))
    landed = tables.scan_json_docs(spark, str(tmp_path / "landed"), WEATHER_DOCUMENT, False, None)
    assert landed.exceptAll(frame).isEmpty() and frame.exceptAll(landed).isEmpty()


# -------------------------------------------------------------------------- html

PAGE = """<!doctype html><div class=menu><table class="m"><tr><td>Home<td>Scores<td>Log in</table></div>
<!-- last year: <table><tr><th>Player</th><th>Runs</th></tr><tr><td>old</td><td>1</td></tr></table> -->
<script>document.write("<table><tr><th>Player</th><th>Runs</th></tr></table>")</script>
<table><caption>Weather</caption><tr><th>Day</th><th>Sky</th></tr><tr><td>Mon</td><td>grey</td></tr></table>
<table border=0><thead><tr><td>No.</td><td><b>Player</b></td><td>Total&nbsp;Runs</td><td>Best</td></tr></thead>
<tbody><tr><td>7<td><a href=x>Z&eacute;lie O&#8217;Ney</a> (QX)<td>1,204<td>88*</tr>
<tr><td>9</td><td>Bo &amp; Co &lt;b&gt; &amp;eacute;</td><td></td><td>&#x2014;</td></tr>
<tr><td colspan="2">did not bat</td><td>0</td><td>0</td></tr></table>"""


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "id int, html string")


def test_table_is_found_by_its_columns(spark):
    found = html.find_table(pages(spark, PAGE), ["id"])
    assert tuple(found.select("status", "n_tables").first()) == ("ok", 3)
    rows = html.rows_to_columns(html.table_rows(found, ["id"]), ["row_idx"], ["No.", "Player", "Total Runs", "Best", "Born"])
    assert [tuple(r) for r in rows.orderBy("row_idx").collect()] == [
        (0, "7", "Zélie O’Ney (QX)", "1,204", "88*", None),
        (1, "9", "Bo & Co <b> &eacute;", "", "—", None),
        (2, "did not bat", "did not bat", "0", "0", None),
    ]


def test_character_references(spark):
    texts = ["&Ouml;&ouml;&#65;&#x1F600;&#X41;", "&unknown; &#0; &#xD800; &#1114112; &", "a &amp;lt; b", "plain", None, "&euro;&frac12;&sup2;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(html.unescaped(F.col("t")))
    assert [r[0] for r in df.collect()] == ["Ööa".replace("a", "A") + "\U0001f600A", "&unknown; &#0; &#xD800; &#1114112; &", "a &lt; b", "plain", None, "€½²"]


@pytest.mark.parametrize(
    ("table", "header", "n_rows"),
    [
        ("<tr><th>Player<th>Runs<tr><td>a<td>1", ["Player", "Runs"], 1),
        ("<thead><tr><td>Player</td><td>Runs</td></tr><tr><td>x</td><td>y</td></tr></thead><tr><td>a</td><td>1</td></tr>", ["Player", "Runs"], 1),
        ("<tr><td>Player</td><td>Runs</td></tr><tr><td>a</td><td>1</td></tr>", [], 2),
        ("<tr><th>Player</th><td>a</td></tr><tr><th>Runs</th><td>1</td></tr>", [], 2),
        ("<thead></thead><tr><th colspan=2>Player</th><th>Runs</th></tr>", ["Player", "Player", "Runs"], 0),
    ],
)
def test_headers(spark, table, header, n_rows):
    df = pages(spark, f"<table>{table}</table>").select(html.parsed_tables(F.col("html")).alias("t"))
    (found,) = df.first()["t"]
    assert found["header"] == header and len(found["rows"]) == n_rows


def test_drift(spark):
    drifted = "<table><thead><tr><th>Rider</th><th>Points</th></tr></thead><tr><td>x</td><td>1</td></tr></table>"
    frame = pages(spark, PAGE, drifted, "<p>no service today</p>", "", None, drifted * 3)
    status = {r["id"]: r["status"] for r in html.drift_status(frame, ["id"]).collect()}
    assert status == {
        0: "ok", 1: "signature_missing", 2: "no_tables", 3: "no_tables", 4: "no_tables", 5: "signature_missing",
    }
    with pytest.raises(Exception, match="schema drift detected: signature_missing"):
        html.require_table(html.find_table(pages(spark, drifted), ["id"])).collect()
    third = html.find_table(frame, ["id"], third_table_fallback=True)
    assert {r["id"] for r in third.where("status = 'ok'").collect()} == {0, 5}


SPANNED = [
    # (rows of a table, its cells), as they are read by eye.
    ("<tr><td rowspan=2>a<td>b<tr><td>c", [["a", "b"], ["a", "c"]]),
    ("<tr><td>a<td rowspan=3>b<tr><td>c<tr><td>d", [["a", "b"], ["c", "b"], ["d", "b"]]),
    ("<tr><td rowspan=2 colspan=2>x<td>y<tr><td>z", [["x", "x", "y"], ["x", "x", "z"]]),
    ("<tr><td rowspan=2>a<td rowspan=2>b<tr><tr><td>c", [["a", "b"], ["a", "b"], ["c"]]),
    ("<tr><td>a<td rowspan=3>b", [["a", "b"], ["b"], ["b"]]),  # beyond the last row
    ("<tr><td>a<td>b<td rowspan=2>c<tr><td>d", [["a", "b", "c"], ["d", "c"]]),  # a row too short to reach the cell
    ("<tr><td rowspan=0>a<td rowspan=x>b<td rowspan='1'>c", [["a", "b", "c"]]),
    ("", []),
]


@pytest.mark.parametrize(("rows", "cells"), SPANNED)
def test_cells_over_several_rows(spark, rows, cells):
    df = pages(spark, f"<table>{rows}</table>").select(html.parsed_tables(F.col("html")).alias("t"))
    (found,) = df.first()["t"]
    assert found["rows"] == cells


def test_tables_inside_tables(spark):
    deepest = "<table id=c><tr><td>deep<td>2</table>"
    inner = f"<table id=b><thead><tr><th>Player<th>Runs</thead><tr><td>in {deepest}<td>1</table>"
    page = f"</table><table id=a><tr><td>x {inner}</td><td>y</td></tr><tr><td>z</table><table><tr><td>last"
    found = pages(spark, page, "no table", "<table>", None).select("id", html.parsed_tables(F.col("html")).alias("t")).collect()
    tables = [(t["header"], t["rows"]) for t in found[0]["t"]]
    assert tables == [
        ([], [["x PlayerRunsin deep21", "y"], ["z"]]),
        (["Player", "Runs"], [["in deep2", "1"]]),
        ([], [["deep", "2"]]),
        ([], [["last"]]),
    ]
    assert [None if r["t"] is None else len(r["t"]) for r in found[1:]] == [0, 1, None]
    assert tuple(html.find_table(pages(spark, page), ["id"]).select("status", "n_tables").first()) == ("ok", 4)


KINDS = [
    # (cells, type that all of them fit, cells that are values)
    (["true", "FALSE", None, " True "], "boolean", 3), (["1", "-2", "+3", "007"], "bigint", 4), (["1", "2.5", "1e3"], "double", 3),
    (["9223372036854775807", "9223372036854775808"], "double", 2), (["2024-02-29", "NA"], "date", 1), (["2024-02-30"], "string", 1),
    (["2024-01-01", "2024-01-01 10:00:00"], "timestamp", 2), (["1", "true"], "string", 2), (["", "NULL", None, " "], "string", 0),
    (["1"] * 50 + ["x"], "string", 51), (["12d"], "string", 1), (["-"], "string", 1),
]


def test_inferred_types(spark):
    names = [f"c.{i}" for i in range(len(KINDS))]
    rows = [tuple(cells[r] if r < len(cells) else None for cells, _, _ in KINDS) for r in range(51)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)).repartition(4)
    found = {r["column_name"]: (r["data_type"], r["n_values"]) for r in infer.column_types(df).collect()}
    assert found == {n: (kind, values) for n, (_, kind, values) in zip(names, KINDS, strict=True)}
    schema = infer.infer_types(df)
    typed = infer.typed(df, schema)
    assert [t for _, t in typed.dtypes] == [kind for _, kind, _ in KINDS]
    assert list(typed.agg(*[F.count(f"`{n}`") for n in names]).first()) == [values for _, _, values in KINDS]


def test_inference_is_one_scan_without_text_shuffles(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.range(100).selectExpr("string(id) as a", "string(id / 2) as b").write.option("header", True).csv(path)
    plan = infer.column_types(spark.read.option("header", True).csv(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange") == 1 and "SinglePartition" in plan
    assert infer.scan_csv_typed(spark, path).dtypes == [("a", "bigint"), ("b", "double")]
    assert infer.column_types(spark.createDataFrame([], "a string")).first()["data_type"] == "string"


def test_pages_are_parsed_once(spark):
    found = html.find_table(pages(spark, PAGE), ["id"]).where("status = 'ok'")
    plan = html.table_rows(found, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1


def test_pages_until_the_first_empty_one(spark):
    data = [("a", 1, 2), ("a", 2, 0), ("a", 3, 5), ("b", 1, 1), ("c", 1, 0), ("d", 1, None)]
    frame = spark.createDataFrame(data, "source string, page int, n int").selectExpr(
        "source", "page", "transform(filter(sequence(0, n), i -> i > 0), i -> array(string(i))) as rows"
    )
    kept = html.paged_union(frame).groupBy("source", "page").count().collect()
    assert sorted(map(tuple, kept)) == [("a", 1, 2), ("b", 1, 1)]
    assert sorted(r["source"] for r in html.sources_without_rows(frame).collect()) == ["c", "d"]
    with pytest.raises(RuntimeError, match="no rows scraped for 2 sources, 'c'"):
        html.require_rows(frame)
    html.require_rows(frame.where("source in ('a', 'b')"))


def test_union_of_tables_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], ["x"]), spark.createDataFrame([(2, 3)], ["x", "y"])
    assert sorted(map(tuple, html.union_tables({"a": a, "b": b}).collect()), key=str) == [(1, None), (2, 3)]


# ------------------------------------------------------------------------ enrich


def test_enrichment_list(spark):
    matches = spark.createDataFrame(
        [("1", "d1", "A"), ("2", "d2", "A"), ("3", None, "A"), ("4", "d", None), ("5", "d", ""), ("6", "d", "B"), ("7", "d", "C")],
        "match_id string, match_date string, city string",
    )
    assert sorted(r["city"] for r in enrich.cities_to_locate(matches).collect()) == ["A", "B", "C"]
    payloads = [("A", '{"results": [{"latitude": 12.97, "longitude": 77.59}, {"latitude": 1.0}]}'),
                ("B", '{"results": [{"latitude": 12.97}]}'), ("C", "{}")]
    lookups = spark.createDataFrame(payloads, "city string, body string").select(
        "city", F.from_json("body", GEOCODE_DOCUMENT)["results"].alias("results")
    )
    requests = enrich.weather_requests(matches, enrich.located(lookups))
    assert sorted(map(tuple, requests.collect())) == [
        ("1", "A", 12.97, 77.59, "d1", "d1"),
        ("2", "A", 12.97, 77.59, "d2", "d2"),
    ]


# ------------------------------------------------------------------- archive directories


def directory(path, range_bytes=1 << 20):
    with archives._open(f"file://{path}") as file:
        place = archives.directory_place(file, file.size())
        return list(archives.directory_entries(file, *place, range_bytes=range_bytes))


def listed(path):
    """What the standard library's reader says."""
    with zipfile.ZipFile(path) as archive:
        return [(e.filename, e.header_offset, e.compress_size, e.compress_type, e.CRC) for e in archive.infolist()]


@pytest.mark.parametrize("range_bytes", [50, 97, 1 << 20])
def test_directories_are_read_by_ranges(tmp_path, range_bytes):
    plain, wide, late, none = (tmp_path / f"{n}.zip" for n in ("plain", "wide", "late", "none"))
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(60):
            archive.writestr(f"é/{i}.json", "x" * i)
    with zipfile.ZipFile(wide, "w") as archive:
        with archive.open(zipfile.ZipInfo("big.json"), "w", force_zip64=True) as entry:
            entry.write(b"123")
        archive.writestr("small.json", "1")
    late.write_bytes(b"#!/bin/sh\n" * 9 + wide.read_bytes())  # an archive behind other bytes
    zipfile.ZipFile(none, "w").close()
    for path in (plain, wide, late, none):
        assert directory(path, range_bytes) == listed(path)
    with zipfile.ZipFile(plain, "a") as archive:
        expected = listed(plain)
        archive.comment = b"a comment with the mark PK\x05\x06 and thirty bytes behind it."
    assert directory(plain, range_bytes) == expected


def test_a_directory_of_many_entries_is_not_held(spark, tmp_path):
    """200,000 entries, so the 64-bit record counts them; a task holds a range and a slice."""
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for i in range(200_000):
            archive.writestr(f"m/{i:06d}.json" if i % 2 else f"m/{i}.txt", "")
    tracemalloc.start()
    try:
        slices = [len(s) for s in archives._list_entries(iter([pd.DataFrame({"archive": [f"file://{path}"]})]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert slices == [10_000] * 10 and peak < 30 << 20
    assert archives.scan_zip_entries(spark, str(tmp_path)).count() == 100_000


def test_broken_directories_fail(tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("a.json", "{}")
    sound = path.read_bytes()
    for broken in (sound[:-22], b"", sound[:-60] + b"?" * 38 + sound[-22:]):
        path.write_bytes(broken)
        with pytest.raises(zipfile.BadZipFile):
            directory(path)


# ----------------------------------------------------------------- entries of archives


class Counted:
    """A file that counts what is asked of it."""

    def __init__(self, file):
        self.file, self.calls = file, 0

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            return getattr(self.file, name)(*args)

        return call


def contents(path, monkeypatch):
    """What the reader finds in an archive, and how often it asks the file."""
    names = ["archive", "entry", "start", "packed", "method", "crc"]
    columns = zip(*((f"file://{path}", *entry) for entry in directory(path)), strict=True)
    rows = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
    files, opened = [], archives._open
    monkeypatch.setattr(archives, "_open", lambda name: files.append(Counted(opened(name))) or files[-1])
    found = pa.Table.from_batches(archives._read_entries(iter([rows]))).to_pylist()
    monkeypatch.undo()
    return {r["entry"]: r["text"] for r in found}, sum(f.calls for f in files)


def test_neighbouring_entries_are_read_at_once(tmp_path, monkeypatch):
    """Four calls for each entry before; now one for a range of neighbours."""
    texts = {f"é/{i}.json": json.dumps(match(city="Zoë" * (i % 50))) for i in range(3000)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in texts.items():
            archive.writestr(name, text)
    found, calls = contents(tmp_path / "a.zip", monkeypatch)
    assert found == texts and calls < 10


def test_entries_apart_and_behind_long_fields_are_read(tmp_path, monkeypatch):
    """Gaps that are skipped, entries larger than a range, and extra fields longer than the reader allows for."""
    texts = {"1.json": "a", "2.json": "b" * (3 << 20), "3.json": "", "4.json": "ü" * 9, "5.json": "c" * 20_000}
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as archive:
        for name, text in texts.items():
            entry = zipfile.ZipInfo(name)
            entry.extra = b"\x99\x99\x00\x20" + bytes(0x2000)
            archive.writestr(entry, text)
    assert contents(tmp_path / "a.zip", monkeypatch)[0] == texts


def test_archives_written_are_sound(tmp_path, monkeypatch):
    """Read by the standard library and by our reader: empty, large and many entries, and offsets beyond 4 GiB."""
    small = {"a/ü.json": "Zoë", "b.json": "", "c.json": "x" * (3 << 20), "d.json": "".join(map(chr, range(0x100, 0x4000)))}
    many = {f"{i}.json": str(i) for i in range(70_000)}
    for start, texts in ((0, {}), (0, small), (0, many), (5 << 30, small)):
        path = tmp_path / f"{start}-{len(texts)}.zip"
        with open(path, "wb") as out:
            out.seek(start)  # a hole, which takes no disk
            assert archives.write_zip(out, ((n, t.encode()) for n, t in texts.items()), start) == len(texts)
        with zipfile.ZipFile(path) as archive:
            assert archive.testzip() is None and {n: archive.read(n).decode() for n in archive.namelist()} == texts
        assert directory(path) == listed(path)
        if texts:
            assert contents(path, monkeypatch)[0] == texts
