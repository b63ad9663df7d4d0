"""Sports-shaped inputs derived from the star-schema test tables, row by row or by key.

``ctes.py`` states the same definitions in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pavilion.operators.columns import computed_once
from pavilion.schemas import BRONZE_BATTING, BRONZE_BOWLING, MATCH_DOCUMENT, WEATHER_DOCUMENT


def _two_decimals(number: str) -> str:
    return f"concat({number} div 100, '.', lpad({number} % 100, 2, '0'))"


def bat_raw(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """Scraped batting rows of the customers; some twice, with junk, marks and gaps."""
    price = F.col("o_totalprice")
    cents = F.round(price * 100).cast("bigint")
    careers = orders.groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.year("o_orderdate")).alias("y0"),
        F.max(F.year("o_orderdate")).alias("y1"),
        F.sum(cents).alias("cents"),
        F.max(cents).alias("top"),
        F.count_if(price > 400000).alias("high"),
        F.count_if((price >= 200000) & (price <= 400000)).alias("mid"),
        F.count_if(price < 10000).alias("low"),
    )
    # Every fourth customer bats under a name that no bowler has.
    name = F.expr("if(c_custkey % 4 = 0, replace(c_name, 'Customer', 'Batter'), c_name)").alias("c_name")
    people = customer.select(F.col("c_custkey").alias("k"), name, F.col("c_nationkey").alias("n_nationkey"))
    counts = ["n", "cents", "top", "high", "mid", "low"]
    rows = (
        people.join(nation.select("n_nationkey", "n_name"), "n_nationkey")
        .join(careers, "k", "left")
        .fillna(0, counts)
        .withColumn("copy", F.explode(F.expr("if(k % 6 = 0, array(0, 1), array(0))")))
        .withColumn("ave", F.expr("(cents div nullif(n, 0)) % 6000"))
        .withColumn("rate", F.expr("(k * 37) % 15000"))
    )
    text = {
        "Player": "case when k % 29 = 0 then null "
        "when copy = 1 then concat(upper(c_name), '  (', n_name, ') ') "
        "else concat(c_name, ' (', n_name, ')') end",
        "Span": "if(k % 41 = 0, string(y0), concat(y0, '-', y1))",
        "Mat": "case when copy = 0 then string(n) when k % 18 = 0 then '-' "
        "when k % 30 = 0 then string(n) else string(n - 1) end",
        "Inns": "if(k % 17 = 0, '-', string(n - copy))",
        "NO": "string(n % 5)",
        "Runs": "if(k % 23 = 0, '-', string(cents div 100000))",
        "HS": "concat(top div 1000000, if(k % 3 = 0, '*', ''))",
        "Ave": f"case when k % 101 = 0 then 'inf' when k % 53 = 0 then '-' else {_two_decimals('ave')} end",
        "BF": "concat(cents div 70000, '.0')",
        "SR": _two_decimals("rate"),
        "100": "string(high)",
        "50": "string(mid)",
        "0": "string(low)",
        "4s": "if(k % 19 = 0, '-', concat(cents div 1000000, if(k % 5 = 0, '+', '')))",
        "6s": "concat(cents div 5000000, if(k % 7 = 0, '+', ''))",
    }
    return rows.selectExpr(*[f"{text[f.name]} as `{f.name}`" for f in BRONZE_BATTING.fields])


def bowl_raw(lineitem: DataFrame) -> DataFrame:
    """Scraped bowling rows of the parts, under names that overlap the batting rows."""
    quantity = F.col("l_quantity").cast("bigint")
    careers = (
        lineitem.groupBy(F.col("l_partkey").alias("k"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.year("l_shipdate")).alias("y0"),
            F.max(F.year("l_shipdate")).alias("y1"),
            F.sum(quantity).alias("balls"),
            F.max(quantity).alias("best"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
            F.count_if(F.col("l_quantity") >= 45).alias("q4"),
            F.count_if(F.col("l_quantity") >= 49).alias("q5"),
        )
    )
    rows = (
        careers.withColumn("copy", F.explode(F.expr("if(k % 10 = 0, array(0, 1), array(0))")))
        .withColumn("ave", F.expr("(cents div (n * 1000)) % 8000"))
        .withColumn("econ", F.expr("(cents div 777) % 1200"))
        .withColumn("rate", F.expr("(balls * 100) div n"))
    )
    text = {
        # Every third part bowls under a name that no batter has.
        "Player": "concat(if(k % 3 = 0, 'Bowler#', 'Customer#'), lpad(k, 9, '0'), ' (NATION_', k % 25, ')')",
        "Span": "if(k % 41 = 0, string(y0), concat(y0, '-', y1))",
        "Mat": "if(copy = 1 and k % 20 = 0, '-', string(n - copy))",
        "Inns": "string(n)",
        "Balls": "string(balls)",
        "Runs": "string(cents div 100000)",
        "Wkts": "case when k % 31 = 0 then '-' when k % 37 = 0 then '0' else string(n) end",
        "BBI": "concat(best, '/', n)",
        "Ave": _two_decimals("ave"),
        "Econ": _two_decimals("econ"),
        "SR": _two_decimals("rate"),
        "4": "string(q4)",
        "5": "string(q5)",
    }
    return rows.selectExpr(*[f"{text[f.name]} as `{f.name}`" for f in BRONZE_BOWLING.fields])


_MATCH = {
    "match_id": "string(o_orderkey)",
    "match_date": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "venue": "if(o_orderkey % 17 = 0, null, o_orderpriority)",
    "city": "if(o_orderkey % 13 = 0, null, concat('C', o_custkey % 200))",
    "team1": "concat('T', o_orderstatus)",
    "team2": "concat('T', o_custkey % 7)",
    "match_type": "if(o_orderkey % 2 = 0, 'T20', 'ODI')",
}


def matches(orders: DataFrame) -> DataFrame:
    """One match header per order."""
    return orders.selectExpr(*[f"{text} as {name}" for name, text in _MATCH.items()])


def balls(lineitem: DataFrame) -> DataFrame:
    """One delivery per line item."""
    return lineitem.selectExpr(
        "string(l_orderkey) as match_id",
        "l_returnflag as batting_team",
        "bigint(l_linenumber) as over_num",
        "concat('P', l_partkey % 200) as batter",
        "concat('S', l_suppkey) as bowler",
        "bigint(l_quantity) % 7 as runs_batter",
        "bigint(l_linenumber % 2) as runs_extras",
        "bigint(l_quantity) % 7 + l_linenumber % 2 as runs_total",
        "case when l_quantity >= 49 then 'caught' when l_quantity >= 45 then 'bowled' end as wicket_kind",
        "case when l_quantity >= 45 then if(l_suppkey % 7 = 0, concat('R', l_suppkey), "
        "concat('P', l_partkey % 200)) end as player_out",
    )


def match_docs(orders: DataFrame) -> DataFrame:
    """A nested match document per order, built from the order's own row."""
    # The lambdas are evaluated node by node, so a delivery's number d is kept in s, k + i + j + d, which most fields ask for.
    number = "(s - i - j)"  # k + d
    wickets = (
        "if(s % 10 > 2, null, case s % 10 "
        f"when 0 then array(struct('bowled' as kind, concat('P', {number} % 200) as player_out)) "
        f"when 1 then array(struct('caught' as kind, concat('Q', {number} % 200) as player_out), "
        "struct('run out' as kind, 'second' as player_out)) "
        "when 2 then array() end)"
    )
    delivery = (
        "struct(concat('P', (s + i * 6 - j) % 200) as batter, concat('S', (k + j) % 50) as bowler, "
        f"struct(s % 7 as batter, {number} % 2 as extras, s % 7 + {number} % 2 as total) as runs, {wickets} as wickets)"
    )
    deliveries = (
        "if((k + j) % 11 = 0, array(), "
        f"transform(sequence(k + i + j + 1, k + i + j + 1 + (k + i + j) % 4), s -> {delivery}))"
    )
    overs = (
        "if((k + i) % 7 = 0, null, transform(sequence(bigint(1), 1 + k % 3), "
        f"j -> struct(j as over, {deliveries} as deliveries)))"
    )
    innings = (
        "case when k % 19 = 0 then null when k % 23 = 0 then array() else "
        "transform(array(bigint(1), bigint(2)), "
        f"i -> struct(concat('T', i) as team, {overs} as overs)) end"
    )
    header = matches(orders).withColumn("k", F.col("match_id").cast("bigint"))
    info = (
        "struct(if(k % 31 = 0, array(), array(match_date)) as dates, venue, city, "
        "array(team1, team2) as teams, match_type)"
    )
    shaped = F.expr(f"struct({info} as info, {innings} as innings)").cast(MATCH_DOCUMENT)
    return header.select("match_id", computed_once(shaped).alias("doc")).select("match_id", "doc.*")


def weather_docs(orders: DataFrame) -> DataFrame:
    """A weather document per order; some have empty arrays, a missing reading or no match."""
    daily = (
        "struct(array(date_format(o_orderdate, 'yyyy-MM-dd')) as time, "
        "case when o_orderkey % 11 = 0 then array() when o_orderkey % 23 = 0 then array(null) "
        "else array(double(o_custkey % 40) + 0.5D) end as temperature_2m_max, "
        # A dry day may come as minus zero; rain does not follow from the precipitation.
        "array(if(o_orderkey % 9 = 0, double('-0.0'), double(o_orderkey % 9))) as precipitation_sum, "
        "array(double(o_custkey % 3)) as rain_sum)"
    )
    # Every tenth document belongs to no known match.
    rows = orders.selectExpr(
        "if(o_orderkey % 10 = 0, concat('x', o_orderkey), string(o_orderkey)) as match_id", f"{daily} as daily"
    )
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_DOCUMENT.fields]
    )


def html_pages(pages: DataFrame) -> DataFrame:
    """The test pages with tables put behind their text: decoys, then a career table.

    Some pages get a table with other headers, some none. A third of the pages
    belongs to one source, and every source has a page without rows in time.
    """
    cells = (
        "concat('<tr class=\"data1\"><td><a href=\"/p\">P', page_id, '-', r, '</a> (T&amp;', page_id % 7, "
        "')</td><td>', page_id * r % 9999, '</td>\\n<td> ', r, '.5 </td></tr>')"
    )
    rows = (
        "if(page_id % 241 = 240, '', array_join(transform(sequence(bigint(1), 1 + page_id % 4), "
        f"r -> {cells}), '\\n'))"
    )
    decoys = (
        "'<!-- <table><tr><th>Player</th><th>Runs</th></tr></table> -->"
        "<table><tr><td>Ad</td></tr></table><TABLE class=\"nav\"><tr><td>A</td><td>B</td></tr></TABLE>'"
    )
    header = "if(page_id % 13 = 12, 'Name', 'Player')"
    career = (
        f"concat('<table id=\"t\">\\n<thead><tr><th>', {header}, '</th><th>Runs</th><th>Ave</th></tr></thead>"
        f"<tbody>', {rows}, '</tbody></table>')"
    )
    return pages.selectExpr(
        "page_id",
        "if(page_id % 3 = 0, 'S0', concat('S', page_id % 20)) as source",
        f"if(page_id % 37 = 36, html, concat(html, {decoys}, {career})) as html",
    )


def skewed(lineitem: DataFrame) -> DataFrame:
    """Line items with a key that holds more than half of the rows."""
    key = F.when(F.col("l_linenumber") <= 4, F.lit(0)).otherwise(F.col("l_partkey"))
    return lineitem.withColumn("k", key.cast("bigint"))


def events_with_gaps(events: DataFrame) -> DataFrame:
    """Events whose value is missing on errors."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return events.select("event_id", "user_id", "event_type", value.alias("value"), "ts")
