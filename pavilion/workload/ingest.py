"""Queries over readers, writers, archives, HTML pages and enrichment lists."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.operators import quality
from pavilion.operators.rank import newest
from pavilion.operators.reshape import flatten_balls, flatten_matches, flatten_weather
from pavilion.plans.daily import conform_audited
from pavilion.schemas import BRONZE_BATTING, MATCH_DOCUMENT, WEATHER_DOCUMENT, with_key
from pavilion.session import materialize, new_folder
from pavilion.sources import archives, commits, enrich, html, infer, tables
from pavilion.workload.ctes import with_tables
from pavilion.workload.registry import query

DAY1, DAY2 = dt.date(2024, 6, 15), dt.date(2024, 6, 16)


@query("scan_csv", with_tables("select * from bat_raw", "bat_raw"))
def scan_csv(src):
    path = new_folder(src.spark, "csv")
    # The source keeps its blanks, as a scraped file would.
    src.bat_raw.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.scan_csv(src.spark, path, BRONZE_BATTING)


@query(
    "scan_csv_by_name",
    with_tables(
        """select "Player", "Span", null::varchar as "Mat", "Runs" from bat_raw""",
        "bat_raw",
    ),
)
def scan_csv_by_name(src):
    """A file with other columns in another order than the schema's."""
    path = new_folder(src.spark, "csv")
    shuffled = src.bat_raw.select("Runs", "HS", "Span", "Player")
    shuffled.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.scan_csv(src.spark, path, BRONZE_BATTING).select("Player", "Span", "Mat", "Runs")


@query(
    "corrupt_documents",
    """select o_orderkey::varchar as match_id, 'document:json' as reasons from orders where o_orderkey % 5 = 0""",
)
def corrupt_documents(src):
    """Every fifth document is cut off; it goes to quarantine and not into the balls."""
    path = new_folder(src.spark, "broken")
    body = F.to_json(F.struct(*[c for c in src.docs.columns if c != "match_id"]))
    key = F.col("match_id").cast("bigint")
    cut = F.when(key % 5 == 0, F.concat(F.lit('{"info": {"city": '), F.to_json(F.struct("match_id")))).otherwise(body)
    packed = src.docs.select("match_id", cut.alias("text"))
    pack_texts(packed, path)
    docs = archives.scan_zip_json(src.spark, path, MATCH_DOCUMENT)
    _, broken = quality.quarantine(docs, [quality.sound_document()])
    return broken.select("match_id", F.concat_ws(",", "reasons").alias("reasons"))


@query(
    "loose_documents",
    """select s_suppkey::varchar as match_id, '2024-06-15' as match_date, s_name as venue,
      case when s_suppkey % 3 = 0 then null else 'C' || s_nationkey end as city, 'X' as team1, 'Y' as team2, 'ODI' as match_type
    from supplier""",
)
def loose_documents(src):
    """One file of several lines per document, keyed by the file's name."""
    folder = new_folder(src.spark, "loose")
    info = F.struct(
        F.array(F.lit("2024-06-15")).alias("dates"), F.col("s_name").alias("venue"),
        F.expr("if(s_suppkey % 3 = 0, null, concat('C', s_nationkey))").alias("city"),
        F.array(F.lit("X"), F.lit("Y")).alias("teams"), F.lit("ODI").alias("match_type"),
    )
    text = F.to_json(F.struct(info.alias("info")), {"pretty": "true"})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, inner = archives.file_system(folder)
        filesystem.create_dir(inner, recursive=True)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with filesystem.open_output_stream(f"{inner}/{row.key}.json") as out:
                    out.write(row.text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    rows = src["supplier"].select(F.col("s_suppkey").cast("string").alias("key"), text.alias("text"))
    rows.mapInPandas(write, "n bigint").agg(F.sum("n")).first()
    return flatten_matches(tables.scan_json_docs(src.spark, f"{folder}/*.json", MATCH_DOCUMENT))


@query("scan_json_docs", with_tables("select * from doc_balls", "doc_balls"))
def scan_json_docs(src):
    path = new_folder(src.spark, "docs")
    tables.land_json(src.docs, path)
    docs = tables.scan_json_docs(
        src.spark, path, with_key(MATCH_DOCUMENT), multi_line=False, key=None
    )
    return flatten_balls(docs)


def pack_texts(texts: DataFrame, folder: str) -> int:
    """Pack (match_id, text) into one zip per partition; a retried task replaces its own archive."""
    file_system, write_zip = archives.file_system, archives.write_zip

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            columns = batch.column("match_id"), batch.column("text").cast(pa.binary())
            # One call turns a whole column into Python's objects; to_pylist goes cell by cell.
            for key, body in zip(*(c.to_numpy(zero_copy_only=False) for c in columns), strict=True):
                yield f"matches/{key}.json", body

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, inner = file_system(folder)
        filesystem.create_dir(inner, recursive=True)
        part = TaskContext.get().partitionId()
        with filesystem.open_output_stream(f"{inner}/part-{part:05d}.zip") as out:
            count = write_zip(out, itertools.chain([("README.txt", b"not a document")], documents(batches)))
        yield pa.RecordBatch.from_pydict({"n": [count - 1]})

    return texts.mapInArrow(pack, "n bigint").agg(F.sum("n")).first()[0]


def write_archives(docs: DataFrame, folder: str) -> int:
    """The documents as JSON, packed."""
    body = F.to_json(F.struct(*[c for c in docs.columns if c != "match_id"]))
    return pack_texts(docs.select("match_id", body.alias("text")), folder)


@query("scan_zip_json", with_tables("select * from doc_balls", "doc_balls"))
def scan_zip_json(src):
    path = new_folder(src.spark, "zip")
    write_archives(src.docs, path)
    return flatten_balls(archives.scan_zip_json(src.spark, path, MATCH_DOCUMENT))


@query(
    "newest_n",
    """select 't20s/' || lpad(o_orderkey::varchar, 12, '0') || '.json' as entry from orders
    order by entry desc limit 50""",
)
def newest_n(src):
    names = F.expr("concat('t20s/', lpad(o_orderkey, 12, '0'), '.json')").alias("entry")
    return newest(src["orders"].select(names), "entry", 50)


def _orders(src) -> DataFrame:
    return src["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


_ORDERS = "o_orderkey, o_custkey, o_totalprice, o_orderstatus"
_REVISED = "o_orderkey, o_custkey, o_totalprice, 'X' as o_orderstatus"


def _revised(orders: DataFrame) -> DataFrame:
    """The same orders with another status, to tell two writes apart."""
    return orders.withColumn("o_orderstatus", F.lit("X"))


def _dated(df: DataFrame) -> DataFrame:
    date = F.col(tables.DATE_COLUMN).cast("string")
    return df.withColumn(tables.DATE_COLUMN, date)


@query(
    "scan_partitions",
    f"""select {_REVISED}, '2024-06-15' as ingestion_date from orders
    union all select {_ORDERS}, '2024-06-16' from orders""",
)
def scan_partitions(src):
    root = new_folder(src.spark, "partitions")
    tables.write_partition(_revised(_orders(src)), root, DAY1)
    tables.write_partition(_orders(src), root, DAY2)
    return _dated(tables.read_table(src.spark, root, _orders(src).schema))


@query("read_partition", f"select {_ORDERS}, '2024-06-16' as ingestion_date from orders")
def read_partition(src):
    root = new_folder(src.spark, "partition")
    tables.write_partition(_revised(_orders(src)), root, DAY1)
    tables.write_partition(_orders(src), root, DAY2)
    return _dated(tables.read_partition(src.spark, root, DAY2, _orders(src).schema))


@query(
    "write_partition_idempotent",
    f"""select {_REVISED}, '2024-06-15' as ingestion_date from orders
    union all select {_ORDERS}, '2024-06-16' from orders""",
)
def write_partition_idempotent(src):
    root = new_folder(src.spark, "idempotent")
    orders = _orders(src)
    tables.write_partition(orders, root, DAY1)
    tables.write_partition(orders, root, DAY2)
    for _ in range(2):  # the first date again, twice, with other values
        tables.write_partition(_revised(orders), root, DAY1)
    return _dated(tables.read_table(src.spark, root, orders.schema))


@query("write_partition_empty", f"select {_ORDERS}, '2024-06-16' as ingestion_date from orders")
def write_partition_empty(src):
    """A date that turns out empty on its second run; the other date stays."""
    root = new_folder(src.spark, "emptied")
    orders = _orders(src)
    for date in (DAY1, DAY2):
        tables.write_partition(orders, root, date)
    tables.write_partition(orders.limit(0), root, DAY1)
    return _dated(tables.read_table(src.spark, root, orders.schema))


@query("write_codec", f"select {_ORDERS}, '2024-06-15' as ingestion_date from orders")
def write_codec(src):
    root = new_folder(src.spark, "codec")
    tables.write_partition(_orders(src), root, DAY1, compression="zstd", dictionary=False, row_group_bytes=1 << 20)
    return _dated(tables.read_table(src.spark, root, _orders(src).schema))


@query("write_full_refresh", f"select {_REVISED} from orders")
def write_full_refresh(src):
    path = new_folder(src.spark, "refresh")
    orders = _orders(src)
    tables.write_full_refresh(orders, path)
    tables.write_full_refresh(_revised(orders), path)
    nothing = orders.where("o_orderkey < 0")
    tables.write_full_refresh(nothing, path, given=nothing)
    return src.spark.read.schema(orders.schema).parquet(path)


@query(
    "commit_of_tables",
    f"""select 'orders' as name, {_ORDERS} from orders union all select 'revised', {_REVISED} from orders
    union all select 'by date', {_ORDERS} from orders where o_orderkey % 2 = 1 union all select 'by date', {_REVISED} from orders""",
)
def commit_of_tables(src):
    """Three tables of one commit, of which the next run replaces a date of one; a third run dies after its first table."""
    root, orders = new_folder(src.spark, "commits"), _orders(src)
    names = [f"{root}/{name}" for name in ("orders", "revised", "by date")]
    with commits.Run(src.spark, f"{root}/log") as run:
        run.write(names[0], orders)
        run.write(names[1], _revised(orders))
        for date in (DAY1, DAY2):
            run.write(names[2], orders, date)
        run.publish()
    with commits.Run(src.spark, f"{root}/log") as run:
        run.write(names[2], _revised(orders), DAY1)
        run.write(names[2], orders.where("o_orderkey % 2 = 1"), DAY2)
        run.publish()
    try:
        with commits.Run(src.spark, f"{root}/log") as run:
            run.write(names[0], orders.limit(0))
            raise InterruptedError
    except InterruptedError:
        pass
    seen = commits.published(src.spark, f"{root}/log")
    parts = [commits.read(src.spark, f"{root}/log", n, orders.schema, manifest=seen).drop(tables.DATE_COLUMN) for n in names]
    named = [p.select(F.lit(n.rsplit("/", 1)[1]).alias("name"), *orders.columns) for n, p in zip(names, parts, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "quarantine_one_pass",
    """select o_orderkey, o_totalprice, null::varchar as reasons from orders where o_totalprice < 200000 and o_orderkey % 7 <> 0
    union all select o_orderkey, o_totalprice, concat_ws(',', case when o_orderkey % 7 = 0 then 'o_orderkey:sevenths' end, case when not o_totalprice < 200000 then 'o_totalprice:price' end)
    from orders where not (o_totalprice < 200000 and o_orderkey % 7 <> 0)""",
)
def quarantine_one_pass(src):
    """Valid and rejected orders, both read from one write that is split by the verdict."""
    root = new_folder(src.spark, "split")
    checks = [
        quality.Check("sevenths", "o_orderkey", F.col("o_orderkey") % 7 == 0),
        quality.Check("price", "o_totalprice", F.col("o_totalprice") >= 200000),
    ]
    orders = src["orders"].select("o_orderkey", "o_totalprice")
    with commits.Run(src.spark, f"{root}/log") as run:
        run.write_split(f"{root}/valid", f"{root}/rejected", orders, checks, DAY1)
        run.publish()
    valid = commits.read(src.spark, f"{root}/log", f"{root}/valid", orders.schema)
    bad = commits.read(src.spark, f"{root}/log", f"{root}/rejected", orders.schema)
    reasons = F.concat_ws(",", "reasons").alias("reasons")
    return valid.select(*orders.columns, F.lit(None).cast("string").alias("reasons")).unionByName(bad.select(*orders.columns, reasons))


@query(
    "row_audit",
    with_tables(
        """select 'batting' as table_name, (select count(*) from bat_raw) as rows_in,
          (select count(*) from silver_batting) as rows_out,
          (select count(*) from bat_raw) - (select count(*) from silver_batting) as dropped_count
        union all select 'bowling', (select count(*) from bowl_raw),
          (select count(*) from silver_bowling),
          (select count(*) from bowl_raw) - (select count(*) from silver_bowling)""",
        "silver_batting",
        "silver_bowling",
    ),
)
def row_audit(src):
    audits = [
        conform_audited(raw, name, new_folder(src.spark, name), DAY1)
        for name, raw in (("batting", src.bat_raw), ("bowling", src.bowl_raw))
    ]
    rows = [(a.table, a.rows_in, a.rows_out, a.dropped) for a in audits]
    return src.spark.createDataFrame(
        rows, "table_name string, rows_in bigint, rows_out bigint, dropped_count bigint"
    )


_PLACES = """places as (
  select city, n * 1.5::double as latitude, n * 0.25::double as longitude
  from (select distinct city, substr(city, 2)::bigint as n from matches where city is not null)
  where n % 7 <> 0 and n % 11 <> 0)"""


@query(
    "enrich_worklist",
    with_tables("", "matches").rstrip()
    + f""", {_PLACES}
    select match_id, m.city, latitude, longitude, match_date as start_date, match_date as end_date
    from matches m join places p on m.city = p.city where match_date is not null""",
)
def enrich_worklist(src):
    number = F.expr("bigint(substr(city, 2))")
    found = F.array(
        F.struct(
            F.when(number % 11 != 0, number * 1.5).alias("latitude"),
            (number * 0.25).cast("double").alias("longitude"),
        ).cast("struct<latitude: double, longitude: double>")
    )
    results = F.when(number % 7 != 0, found).otherwise(F.array().cast(found_type))
    lookups = enrich.cities_to_locate(src.matches).withColumn("results", results)
    return enrich.weather_requests(src.matches, enrich.located(lookups))


found_type = "array<struct<latitude: double, longitude: double>>"


@query("land_json", with_tables("select * from weather", "weather"))
def land_json(src):
    path = new_folder(src.spark, "weather")
    tables.land_json(enrich.keyed_payload(src.weather_docs), path)
    docs = tables.scan_json_docs(src.spark, path, WEATHER_DOCUMENT, multi_line=False, key=None)
    return flatten_weather(docs)


@query("flatten_weather", with_tables("select * from weather", "weather"))
def flatten_weather_docs(src):
    return flatten_weather(src.weather_docs)


@query("flatten_matches", with_tables("select * from doc_matches", "doc_matches"))
def flatten_match_docs(src):
    return flatten_matches(src.docs)


@query("flatten_balls", with_tables("select * from doc_balls", "doc_balls"))
def flatten_ball_docs(src):
    return flatten_balls(src.docs)


@query(
    "html_table_rows",
    with_tables("select page_id, row_idx, player, runs, ave from page_rows", "page_rows"),
)
def html_table_rows(src):
    found = html.find_table(src.html_pages, ["page_id"])
    rows = html.table_rows(found, ["page_id"])
    cells = html.rows_to_columns(rows, ["page_id", "row_idx"], ["Player", "Runs", "Ave"])
    return cells.withColumnsRenamed({"Player": "player", "Runs": "runs", "Ave": "ave"})


@query(
    "page_drift_status",
    """select page_id, case when regexp_matches(html, '(?i)<table[^>]*>') then 'signature_missing'
      else 'no_tables' end as status from pages""",
)
def page_drift_status(src):
    return html.drift_status(src["pages"], ["page_id"])


@query(
    "page_drift_mixed",
    """select page_id, case when page_id % 37 = 36 then 'no_tables'
      when page_id % 13 = 12 then 'signature_missing' else 'ok' end as status from pages""",
)
def page_drift_mixed(src):
    return html.drift_status(src.html_pages, ["page_id"])


_SOURCE = "case when page_id % 3 = 0 then 'S0' else 'S' || (page_id % 20) end"


@query(
    "paged_union",
    with_tables(
        f"""select r.source, r.page_id as page, 'ok' as status, row_idx, player from page_rows r
        left join (select {_SOURCE} as source, min(page_id) as stop from pages
          where page_id % 37 <> 36 and page_id % 13 <> 12 and page_id % 241 = 240 group by 1) s
          on r.source = s.source
        where stop is null or r.page_id < stop
        union all select {_SOURCE}, page_id, case when page_id % 37 = 36 then 'no_tables' else 'signature_missing' end,
          null::integer, null from pages where page_id % 37 = 36 or page_id % 13 = 12""",
        "page_rows",
    ),
)
def paged_union(src):
    """Rows of the pages that have their table, and a row for each page that has not."""
    pages = html.find_table(src.html_pages.withColumnRenamed("page_id", "page"), ["source", "page"])
    # Read three times below, so the parsed rows are kept rather than the pages parsed again.
    pages = materialize(pages, "pages")
    rows = html.paged_union(pages.where("status = 'ok'"))
    rows = rows.select("source", "page", F.lit("ok").alias("status"), "row_idx", F.get("cells", F.lit(0)).alias("player"))
    drifted = pages.where("status <> 'ok'").select("source", "page", "status")
    return html.union_tables({"rows": rows, "drifted": drifted})


@query(
    "html_headers_and_references",
    """select page_id, case when page_id % 2 = 0 then 'Player' else 'Side' end as first_header, row_idx::integer as row_idx, cells from (
      select page_id, 0 as row_idx, 'Zoë & Co €' || (page_id % 10) || ' 🏏|<b>|' || page_id || '|' || page_id as cells from pages
      union all select page_id, 1, 'wide|wide|wide|end' from pages)""",
)
def html_headers_and_references(src):
    """Headers of plain cells, the third table in default of a named one, references and spanning cells."""
    head = F.expr(
        "if(page_id % 2 = 0, '<thead><tr><td>Player</td><td>Total Runs</td><td>Note</td></tr></thead>', '<tr><th>Side</th></tr>')"
    )
    rows = F.expr(
        "concat('<tr><td>Zo&euml; &amp;&nbsp;Co &#8364;', page_id % 10, ' &#x1F3CF;</td><td>&lt;b&gt;</td><td colspan=2>', page_id, '</td></tr>"
        "<tr><td colspan=\"3\">wide</td><td>end</td></tr></table>')"
    )
    decoys = F.lit("<table><tr><td>x</td></tr></table><table><tr><td>y</td></tr></table><table>")
    pages = src.spread("pages").select("page_id", F.concat(decoys, head, rows).alias("html"))
    found = html.find_table(pages, ["page_id"], third_table_fallback=True)
    return html.table_rows(found, ["page_id"]).select(
        "page_id", F.get("header", F.lit(0)).alias("first_header"), "row_idx", F.array_join("cells", "|").alias("cells")
    )


_SPANS = """(select page_id, unnest([
  {'table_no': 0, 'row_idx': 0, 'cells': 'outer|first a1 a2b1|' || page_id},
  {'table_no': 0, 'row_idx': 1, 'cells': 'outer|second|' || page_id},
  {'table_no': 0, 'row_idx': 2, 'cells': 'tail|tail|last'},
  {'table_no': 0, 'row_idx': 3, 'cells': 'last'},
  {'table_no': 1, 'row_idx': 0, 'cells': 'a1|a2'},
  {'table_no': 1, 'row_idx': 1, 'cells': 'b1|a2'}]) as r from pages)"""


@query("html_spans_and_nested", f"select page_id, r.table_no, r.row_idx, r.cells from {_SPANS}")
def html_spans_and_nested(src):
    """Every page has a table with cells over several rows and columns, and a table inside a cell."""
    inner = "<TABLE><tr><td>a1<td rowspan=2> a2</tr><tr><td>b1</table>"
    page = F.concat(
        F.lit(f"<p><table class=x><tr><td rowspan='2'>outer</td><td>first {inner}</td><td rowspan=2>"),
        F.col("page_id").cast("string"),
        F.lit("</td></tr><tr><td>second</td></tr><tr><td colspan=2>tail</td><td rowspan=2>last</td></tr></table></table>"),
    )
    tables = F.posexplode(html.parsed_tables(F.col("html"))).alias("table_no", "t")
    parsed = src.spread("pages").select("page_id", page.alias("html")).select("page_id", tables)
    rows = parsed.select("page_id", "table_no", F.posexplode("t.rows").alias("row_idx", "row"))
    return rows.select("page_id", "table_no", "row_idx", F.array_join("row", "|").alias("cells"))


_CELLS = """cells as (
  select o_orderkey::varchar as id, o_totalprice::varchar as price, (o_orderkey % 2 = 0)::varchar as even,
    strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d') || ' 12:30:00' as noon,
    case when o_orderkey = (select max(o_orderkey) from orders) then 'n/k' else o_custkey::varchar end as late,
    case when o_orderkey % 3 = 0 then 'NA' else (o_orderkey * 2)::varchar end as gaps,
    case when o_orderkey = (select min(o_orderkey) from orders) then '2.5' else o_orderkey::varchar end as half, 'NULL' as nothing from orders)"""


def _cells_file(src) -> str:
    """A CSV file of every type; one column turns to text by its very last cell."""
    path = new_folder(src.spark, "csv")
    low, high = src["orders"].agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    rows = src["orders"].select(
        F.expr("cast(o_orderkey as string)").alias("id"),
        F.expr("cast(o_totalprice as string)").alias("price"),
        F.expr("initcap(cast(o_orderkey % 2 = 0 as string))").alias("even"),
        F.expr("date_format(o_orderdate, 'yyyy-MM-dd')").alias("day"),
        F.expr("concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 12:30:00')").alias("noon"),
        F.expr(f"if(o_orderkey = {high}, 'n/k', cast(o_custkey as string))").alias("late"),
        F.expr("if(o_orderkey % 3 = 0, 'NA', concat(' ', o_orderkey * 2))").alias("gaps"),
        F.expr(f"if(o_orderkey = {low}, '2.5', cast(o_orderkey as string))").alias("half"),
        F.lit("NULL").alias("nothing"),
    )
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


@query(
    "infer_types",
    f"""with {_CELLS}, n as (select count(*) as n, count(*) filter (gaps <> 'NA') as g from cells)
    select * from (select unnest(['id', 'price', 'even', 'day', 'noon', 'late', 'gaps', 'half', 'nothing']) as column_name,
      unnest(['bigint', 'double', 'boolean', 'date', 'timestamp', 'string', 'bigint', 'double', 'string']) as data_type,
      unnest([n, n, n, n, n, n, g, n, 0]) as n_values from n)""",
)
def infer_types(src):
    return infer.column_types(src.spark.read.option("header", True).csv(_cells_file(src)))


@query(
    "scan_csv_typed",
    f"""with {_CELLS} select id::bigint as id, price::double as price, even::boolean as even, day, noon, late,
      try_cast(gaps as bigint) as gaps, half::double as half, null::varchar as nothing from cells""",
)
def scan_csv_typed(src):
    rows = infer.scan_csv_typed(src.spark, _cells_file(src))
    return rows.withColumns({"day": F.date_format("day", "yyyy-MM-dd"), "noon": F.date_format("noon", "yyyy-MM-dd HH:mm:ss")})
