"""Queries over column functions and column-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pavilion.functions import keys, numbers, scores, text
from pavilion.operators import columns
from pavilion.plans import conform
from pavilion.schemas import SILVER_BATTING
from pavilion.sources import enrich
from pavilion.workload import ctes
from pavilion.workload.ctes import with_tables
from pavilion.workload.registry import query


@query(
    "split_tag",
    with_tables(
        f"""select "Player" as raw, {ctes.clean_name('"Player"')} as player,
        {ctes.name_tag('"Player"')} as country_tag from bat_raw""",
        "bat_raw",
    ),
)
def split_tag(src):
    raw = F.col("Player")
    return src.bat_raw.select(
        raw.alias("raw"),
        text.clean_name(raw).alias("player"),
        text.name_tag(raw).alias("country_tag"),
    )


@query(
    "parse_span",
    with_tables(
        f"""select "Player" as raw, {ctes.span_year('"Span"', 1)} as start_year,
        {ctes.span_year('"Span"', 2)} as end_year from bat_raw""",
        "bat_raw",
    ),
)
def parse_span(src):
    start, end = text.span_years(F.col("Span"))
    return src.bat_raw.select(
        F.col("Player").alias("raw"), start.alias("start_year"), end.alias("end_year")
    )


def _marked(src, column, mark, flag):
    value, present = text.marked_number(F.col(columns.quoted(column)), mark)
    return src.bat_raw.select(
        F.col("Player").alias("raw"), value.alias("value"), present.alias(flag)
    )


@query(
    "strip_plus",
    with_tables(
        f"""select "Player" as raw, {ctes.marked('"4s"', '+')} as value,
        {ctes.flag('"4s"', '+')} as is_lower_bound from bat_raw""",
        "bat_raw",
    ),
)
def strip_plus(src):
    return _marked(src, "4s", "+", "is_lower_bound")


@query(
    "strip_star",
    with_tables(
        f"""select "Player" as raw, {ctes.marked('"HS"', '*')} as value,
        {ctes.flag('"HS"', '*')} as not_out from bat_raw""",
        "bat_raw",
    ),
)
def strip_star(src):
    return _marked(src, "HS", "*", "not_out")


# A text per line item: whole, with a zero fraction, with a real fraction, junk, or spaced.
_TEXTS = {
    "spark": """case l_partkey % 6 when 0 then string(l_orderkey) when 1 then concat(l_orderkey, '.0')
        when 2 then concat(l_orderkey, '.7') when 3 then '-' when 4 then concat(' ', l_orderkey, ' ')
        else case l_linenumber % 4 when 0 then 'inf' when 1 then '-Infinity' when 2 then 'n/a'
        else '12d' end end""",
    "sql": """case l_partkey % 6 when 0 then l_orderkey::varchar when 1 then l_orderkey || '.0'
        when 2 then l_orderkey || '.7' when 3 then '-' when 4 then ' ' || l_orderkey || ' '
        else case l_linenumber % 4 when 0 then 'inf' when 1 then '-Infinity' when 2 then 'n/a'
        else '12d' end end""",
}


@query(
    "safe_int",
    f"""select l_orderkey, l_linenumber, t as raw, {ctes.as_int('t')} as value
    from (select *, {_TEXTS['sql']} as t from lineitem)""",
)
def safe_int(src):
    rows = src["lineitem"].withColumn("t", F.expr(_TEXTS["spark"]))
    value = numbers.safe_int(F.col("t")).alias("value")
    return rows.select("l_orderkey", "l_linenumber", F.col("t").alias("raw"), value)


@query(
    "exact_int",
    "select o_orderkey, '900719925474' || lpad((o_orderkey % 10000)::varchar, 4, '0') as raw, "
    "('900719925474' || lpad((o_orderkey % 10000)::varchar, 4, '0'))::bigint as value from orders",
)
def exact_int(src):
    """Integers that a double cannot hold."""
    raw = F.expr("concat('900719925474', lpad(o_orderkey % 10000, 4, '0'))")
    return src["orders"].select("o_orderkey", raw.alias("raw"), numbers.safe_int(raw).alias("value"))


@query(
    "safe_double",
    f"""select l_orderkey, l_linenumber, t as raw, {ctes.as_double('t')} as value
    from (select *, {_TEXTS['sql']} as t from lineitem)""",
)
def safe_double(src):
    rows = src["lineitem"].withColumn("t", F.expr(_TEXTS["spark"]))
    value = numbers.safe_double(F.col("t")).alias("value")
    return rows.select("l_orderkey", "l_linenumber", F.col("t").alias("raw"), value)


@query(
    "coerce_numeric",
    with_tables(
        f"""select "Player" as player, "Span" as span, {ctes.as_double('"Runs"')} as runs,
        {ctes.as_double('"Ave"')} as ave, {ctes.as_double('"4s"')} as fours from bat_raw""",
        "bat_raw",
    ),
)
def coerce_numeric(src):
    coerced = columns.coerce_numeric(src.bat_raw, ["Runs", "Ave", "4s"])
    return coerced.selectExpr(
        "Player as player", "Span as span", "Runs as runs", "Ave as ave", "`4s` as fours"
    )


@query(
    "drop_index_cols",
    with_tables('select "Player", "Span", "Runs" from bat_raw', "bat_raw"),
)
def drop_index_cols(src):
    indexed = src.bat_raw.select(
        F.lit(0).alias("Unnamed: 0"), F.lit("0").alias("_c0"), "Player", "Span", "Runs"
    )
    return columns.drop_index_columns(indexed)


_RENAMED = {
    raw: name for raw, name in conform.BATTING_ALIASES.items()
    if raw in "Player Span Mat Inns NO Runs HS Ave BF SR 100 50 0 4s 6s".split()
}


@query(
    "conform_rename",
    with_tables(
        "select " + ", ".join(f'"{raw}" as {name}' for raw, name in _RENAMED.items()) + " from bat_raw",
        "bat_raw",
    ),
)
def conform_rename(src):
    return columns.rename_known(src.bat_raw, conform.BATTING_ALIASES)


_COMPLETED = {
    "player": "player",
    "runs": "runs",
    "fours_is_lower_bound": "false",
    "sixes_is_lower_bound": "false",
    "high_score_not_out": "false",
}
_SQL_TYPES = {"bigint": "bigint", "double": "double", "string": "varchar", "boolean": "boolean"}


@query(
    "complete_schema",
    with_tables(
        "select "
        + ", ".join(
            f"{_COMPLETED.get(f.name, 'null')}::{_SQL_TYPES[f.dataType.simpleString()]} as {f.name}"
            for f in SILVER_BATTING.fields
        )
        + " from typed_batting",
        "typed_batting",
    ),
)
def complete_schema(src):
    partial = src.typed_batting.select("player", "runs")
    flags = ("fours_is_lower_bound", "sixes_is_lower_bound", "high_score_not_out")
    return columns.complete_schema(partial, SILVER_BATTING, dict.fromkeys(flags, False))


@query(
    "content_key",
    with_tables(
        """select match_id, sha256(concat_ws('_', team1, team2, match_date)) as content_key
        from doc_matches""",
        "doc_matches",
    ),
)
def content_key(src):
    key = keys.content_key(F.col("info.teams"), F.col("info.dates"))
    return src.docs.select("match_id", key.alias("content_key"))


@query(
    "surrogate_key",
    with_tables(
        """select match_id, md5(coalesce(venue, '_dbt_utils_surrogate_key_null_') || '-'
        || coalesce(city, '_dbt_utils_surrogate_key_null_')) as venue_id from matches""",
        "matches",
    ),
)
def surrogate_key(src):
    key = keys.surrogate_key(F.col("venue"), F.col("city"))
    return src.matches.select("match_id", key.alias("venue_id"))


@query(
    "key_from_path",
    """select o_orderkey, case when o_orderkey % 5 = 0 then '' else o_orderkey::varchar end as match_id
    from orders""",
)
def key_from_path(src):
    path = "if(o_orderkey % 5 = 0, 's3a://lake/bronze/readme.txt', concat('s3a://lake/bronze/', o_orderkey, '.json'))"
    return src["orders"].select("o_orderkey", text.file_key(F.expr(path)).alias("match_id"))


@query(
    "weather_band",
    with_tables(
        """select match_id, case when precip_mm > 5 then 'Rainy' when temp_max_c > 30 then 'Hot'
        when temp_max_c < 15 then 'Cold' else 'Moderate' end as weather_condition from weather""",
        "weather",
    ),
)
def weather_band(src):
    from pavilion.operators.reshape import flatten_weather

    band = scores.weather_band(F.col("temp_max_c"), F.col("precip_mm"))
    return flatten_weather(src.weather_docs).select("match_id", band.alias("weather_condition"))


@query(
    "first_geocode",
    """select o_orderkey,
      case when o_orderkey % 3 = 0 or o_orderkey % 5 = 0 then null
        else (o_custkey % 90)::double end as latitude,
      case when o_orderkey % 3 = 0 or o_orderkey % 5 = 0 then null
        else (o_custkey % 180)::double end as longitude
    from orders""",
)
def first_geocode(src):
    results = F.expr(
        """transform(sequence(1, 2), i -> struct(
          if(o_orderkey % 5 = 0, null, double(o_custkey % 90) * i) as latitude,
          double(o_custkey % 180) * i as longitude))"""
    )
    lookups = src["orders"].select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, results).alias("results")
    )
    place = lookups.select("o_orderkey", enrich.first_coordinates(F.col("results")).alias("place"))
    return place.select("o_orderkey", "place.latitude", "place.longitude")
