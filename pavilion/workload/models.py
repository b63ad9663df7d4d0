"""Queries over conforming, staging, joins, marts and read functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pavilion.operators import dedupe, joins, quality
from pavilion.plans import conform, contracts, marts, refit, serving, staging
from pavilion.session import materialize, new_folder
from pavilion.sources.tables import read_with_row_id
from pavilion.workload import ctes, inputs
from pavilion.workload.ctes import with_tables
from pavilion.workload.registry import query
from pavilion.workload.rules import RANKED

def _all(name: str) -> str:
    return with_tables(f"select * from {name}", name)


query("conform_batting", _all("silver_batting"))(lambda src: src.silver_batting)
query("conform_bowling", _all("silver_bowling"))(lambda src: src.silver_bowling)
query("stg_batting", _all("stg_batting"))(lambda src: src.stg_batting)
query("stg_bowling", _all("stg_bowling"))(lambda src: src.stg_bowling)
query("stg_balls", _all("balls"))(lambda src: staging.stg_balls(src.balls))
query("stg_matches", _all("matches"))(lambda src: staging.stg_matches(src.matches))
query("stg_weather", _all("stg_weather"))(lambda src: src.stg_weather)
query("dim_player", _all("dim_player"))(lambda src: src.dim_player)
query("fact_ball", _all("fact_ball"))(lambda src: src.fact_ball)
query("dim_weather", _all("dim_weather"))(lambda src: src.dim_weather)
query("dim_player_src", _all("dim_player_src"))(lambda src: marts.dim_player_source(src.balls))


query("dim_venue", _all("dim_venue"))(lambda src: marts.dim_venue(src.matches))


@query(
    "ball_tests",
    with_tables(
        """select 'matches' as table_name, 'match_id' as column_name, 'not_null' as check_name, 0 as violations
        union all select 'matches', 'match_id', 'unique', count(*) from (select 1 from matches group by match_id having count(*) > 1)
        union all select 'dim_player_source', 'player_id', 'unique', count(*) from (select 1 from dim_player_src group by player_id having count(*) > 1)
        union all select 'dim_venue', 'venue_id', 'unique', count(*) from (select 1 from dim_venue group by venue_id having count(*) > 1)
        union all select 'dim_weather', 'weather_id', 'unique', count(*) from (select 1 from dim_weather group by weather_id having count(*) > 1)
        union all select 'fact_ball_by_ball', c, 'not_null', 0 from (values ('match_id'), ('batter_id'), ('bowler_id')) t(c)
        union all select 'fact_ball_by_ball', 'match_id', 'references', count(*) from balls anti join matches using (match_id)
        union all select 'fact_ball_by_ball', c, 'references', 0 from (values ('batter_id'), ('bowler_id')) t(c)""",
        "dim_player_src",
        "dim_venue",
        "dim_weather",
    ),
)
def ball_tests(src):
    """The key of the matches and the ball-by-ball tables that are built with it."""
    built = {
        "matches": src.matches,
        "dim_player_source": marts.dim_player_source(src.balls),
        "dim_venue": marts.dim_venue(src.matches),
        "dim_weather": src.dim_weather,
        "fact_ball_by_ball": src.fact_ball,
    }
    return quality.run_tests(built, [*contracts.match_tests(), *contracts.ball_tests()])


@query(
    "weather_orphans",
    with_tables(
        """select count(*) as n_balls from fact_ball where weather_id not in (select weather_id from dim_weather)
          and match_id in (select match_id from stg_weather)""",
        "fact_ball",
        "dim_weather",
    ),
)
def weather_orphans(src):
    """Balls of matches with weather whose weather key the dimension lacks."""
    known = src.fact_ball.join(src.stg_weather, "match_id", "left_semi")
    return quality.orphans(known, "weather_id", src.dim_weather, "weather_id").agg(F.count(F.lit(1)).alias("n_balls"))


_SECOND = """select c_name || ' ' as "Player", case when c_custkey % 5 = 0 then null else n_name end as "Country",
      case when c_custkey % 7 = 0 then null else 1980 + c_custkey % 20 end as "Start", 1999 + c_custkey % 20 as "End",
      c_custkey % 300 as "Matches", (c_custkey % 400) || '.0' as "Innings",
      case when c_custkey % 11 = 0 then null else c_custkey * 3 || '.0' end as "Runs",
      (c_custkey % 150) || '.0' as "HighScore", c_custkey % 2 = 0 as "HighScoreNotOut",
      case when c_custkey % 13 = 0 then 'inf' else (c_custkey % 60) || '.25' end as "Average"
    from customer join nation on c_nationkey = n_nationkey"""


@query(
    "conform_second_spelling",
    f"""select lower(trim("Player")) as player, "Country" as country_tag, "Start"::bigint as career_start_year,
      "End"::bigint as career_end_year, "Matches"::bigint as matches, {ctes.as_int('"Innings"')} as innings,
      {ctes.as_int('"Runs"')} as runs, {ctes.as_int('"HighScore"')} as high_score, "HighScoreNotOut" as high_score_not_out,
      {ctes.as_double('"Average"')} as average
    from ({_SECOND}) where "Runs" is not null""",
)
def conform_second_spelling(src):
    """Rows under the headers of the sample files, with country and years in columns of their own."""
    key = "c_custkey"
    raw = src["customer"].join(src["nation"], F.expr("c_nationkey = n_nationkey")).selectExpr(
        "concat(c_name, ' ') as Player", f"if({key} % 5 = 0, null, n_name) as Country",
        f"if({key} % 7 = 0, null, 1980 + {key} % 20) as Start", f"1999 + {key} % 20 as End", f"{key} % 300 as Matches",
        f"concat({key} % 400, '.0') as Innings", f"if({key} % 11 = 0, null, concat({key} * 3, '.0')) as Runs",
        f"concat({key} % 150, '.0') as HighScore", f"{key} % 2 = 0 as HighScoreNotOut",
        f"if({key} % 13 = 0, 'inf', concat({key} % 60, '.25')) as Average",
    )
    return conform.conform_batting(raw, with_high_score=True).select(
        "player", "country_tag", "career_start_year", "career_end_year", "matches", "innings", "runs",
        "high_score", "high_score_not_out", "average",
    )


@query("full_outer_nullsafe", with_tables("select * from careers", "careers"))
def full_outer_nullsafe(src):
    return marts.joined_careers(src.stg_batting, src.stg_bowling)


@query(
    "player_role", with_tables("select player, career_start_year, player_role from scored", "scored")
)
def player_role(src):
    return src.dim_player.select("player", "career_start_year", "player_role")


@query(
    "score_batting",
    with_tables("select player, career_start_year, pca_batting_score as score from scored", "scored"),
)
def score_batting(src):
    return src.dim_player.select(
        "player", "career_start_year", F.col("pca_batting_score").alias("score")
    )


@query(
    "score_bowling",
    with_tables("select player, career_start_year, pca_bowling_score as score from scored", "scored"),
)
def score_bowling(src):
    return src.dim_player.select(
        "player", "career_start_year", F.col("pca_bowling_score").alias("score")
    )


@query("fact_long", with_tables("select * from fact_long", "fact_long"))
def fact_long(src):
    return src.fact_long


_BEST = "order by pca_score desc nulls last, player asc nulls last, career_start_year asc nulls last"


@query(
    "mart_top_batsmen",
    with_tables(f"select row_number() over ({_BEST}) as rank, * from batsmen", "batsmen"),
)
def mart_top_batsmen(src):
    return marts.mart_top_batsmen(src.dim_player, RANKED)


@query(
    "mart_top_bowlers",
    with_tables(f"select row_number() over ({_BEST}) as rank, * from bowlers", "bowlers"),
)
def mart_top_bowlers(src):
    return marts.mart_top_bowlers(src.dim_player, RANKED)


def _rankings_sql(table: str, metric: str, limit: int) -> str:
    return with_tables(
        f"""select row_number() over ({_BEST}) as rank, player, country_tag, pca_score, matches,
        {metric} as primary_metric from {table} order by rank limit {limit}""",
        table,
    )


@query("rankings_batsmen", _rankings_sql("batsmen", "runs", 25))
def rankings_batsmen(src):
    return serving.rankings_batsmen(marts.batsmen(src.dim_player, RANKED))


@query("rankings_bowlers", _rankings_sql("bowlers", "wickets", 50))
def rankings_bowlers(src):
    return serving.rankings_bowlers(marts.bowlers(src.dim_player, RANKED), limit=50)


_PLAYER = "player, country_tag, matches, innings, runs, wickets, pca_score"


@query(
    "player_stats",
    with_tables(
        f"select {_PLAYER} from dim_player where lower(player) = lower('CUSTOMER#000000055')",
        "dim_player",
    ),
)
def player_stats(src):
    return serving.player_stats(src.dim_player, "CUSTOMER#000000055")


@query(
    "players_page",
    with_tables(
        f"""select (select count(*) from dim_player) as total, {_PLAYER} from dim_player
        order by player asc nulls last, career_start_year asc nulls last limit 50 offset 100""",
        "dim_player",
    ),
)
def players_page(src):
    return serving.players_page(src.dim_player, limit=50, offset=100)


@query(
    "players_pages",
    with_tables(
        f"""select row_number() over (order by player nulls last, career_start_year nulls last) as rank, (select count(*) from dim_player) as total, {_PLAYER}
        from dim_player qualify rank <= 40 or rank between 121 and 135 or rank > (select count(*) from dim_player) - 7""",
        "dim_player",
    ),
)
def players_pages(src):
    """Three pages of the players, written once in order with a rank directory."""
    path = new_folder(src.spark, "players")
    serving.write_players(src.dim_player, path)
    first = serving.read_players(src.spark, path, 40, 0)
    total = first.first()["total"]
    return first.unionByName(serving.read_players(src.spark, path, 15, 120)).unionByName(serving.read_players(src.spark, path, 500, total - 7))


@query(
    "mart_counts",
    with_tables(
        """select 'mart_top_batsmen' as mart, count(*) as n_rows from batsmen
        union all select 'mart_top_bowlers', count(*) from bowlers""",
        "batsmen",
        "bowlers",
    ),
)
def mart_counts(src):
    return serving.mart_counts(
        {
            # Ranks do not change the number of rows, so they are not computed.
            "mart_top_batsmen": marts.batsmen(src.dim_player, RANKED),
            "mart_top_bowlers": marts.bowlers(src.dim_player, RANKED),
        }
    )


def _context_sql(where: str = "true") -> str:
    return with_tables(
        f"""select p.player_name as player,
          sum(case when w.weather_condition = 'Rainy' then f.runs_batter end)::double
            / nullif(count(case when w.weather_condition = 'Rainy' then f.runs_batter end), 0)
            as avg_runs_in_rain,
          sum(case when w.weather_condition = 'Hot' then f.runs_batter end)::double
            / nullif(count(case when w.weather_condition = 'Hot' then f.runs_batter end), 0)
            as avg_runs_in_hot,
          count(f.match_id) as total_balls_faced
        from fact_ball f join dim_player_src p on f.batter_id = p.player_id
          left join (select distinct weather_id, weather_condition from dim_weather) w
          on f.weather_id = w.weather_id
        where {where} group by p.player_name""",
        "fact_ball",
        "dim_player_src",
        "dim_weather",
    )


def _context(src, name_part=None, literal=False):
    weather = src.dim_weather
    players = marts.dim_player_source(src.balls)
    return serving.player_context(src.fact_ball, players, weather, name_part, literal)


@query("player_context", _context_sql())
def player_context(src):
    return _context(src)


@query("context_by_name", _context_sql("lower(p.player_name) like lower('%p_1%')"))
def context_by_name(src):
    return _context(src, "p_1")


# ------------------------------------------------------------------ keys and skew

_SKEWED = """select l_orderkey, l_linenumber, l_quantity, s.k, p_name, p_brand, p_retailprice
    from skewed s left join part p on s.k = p.p_partkey"""


def skew_sides(src):
    rows = inputs.skewed(read_with_row_id(src.spark, src.path("lineitem")))
    left = rows.select("l_orderkey", "l_linenumber", "l_quantity", "k", "row_id")
    right = src["part"].selectExpr("p_partkey as k", "p_name", "p_brand", "p_retailprice")
    return left, right


@query("salted_join", with_tables(_SKEWED, "skewed"))
def salted_join(src):
    left, right = skew_sides(src)
    return joins.salted_join(left, right, "k", salt_by=["row_id"], hint="merge").drop("row_id")


@query("hot_key_join", with_tables(_SKEWED, "skewed"))
def hot_key_join(src):
    left, right = skew_sides(src)
    left = materialize(left, "left")  # read for the counts and for the join
    joined = joins.hot_key_join(left, right, "k", rows_per_task=5000, salt_by=["row_id"], hint="merge")
    return joined.drop("row_id")


@query(
    "hot_keys",
    with_tables("select k, ceil(count(*) / 500)::integer as salts from skewed_left where k is not null group by k having count(*) > 500", "skewed_left"),
)
def hot_keys(src):
    """Keys of more rows than a task should have: named by a sketch, counted exactly."""
    left, _ = skew_sides(src)
    return joins.hot_keys(materialize(left, "left"), "k", 500).withColumnRenamed("__salts", "salts")


_WIDE = ", ".join(f"w.{c} as bowl_{c}" for c in ctes.SILVER_BOWLING)


@query(
    "player_stats_wide",
    with_tables(
        f"""select b.*, {_WIDE} from silver_batting b left join silver_bowling w
        on {ctes.clean_name('b.player')} = {ctes.clean_name('w.player')}""",
        "silver_batting",
        "silver_bowling",
    ),
)
def player_stats_wide(src):
    return marts.player_stats_wide(materialize(src.silver_batting, "batting"), src.silver_bowling)


@query(
    "player_stats_by_day",
    with_tables(
        f"""select b.*, '2024-06-1' || d as ingestion_date, {_WIDE} from silver_batting b
        cross join (values (5), (6), (7)) t(d)
        left join silver_bowling w on {ctes.clean_name('b.player')} = {ctes.clean_name('w.player')}""",
        "silver_batting",
        "silver_bowling",
    ),
)
def player_stats_by_day(src):
    """Three ingestion dates: a batting row meets the bowling row of its own date only."""

    def daily(df, name):
        days = F.explode(F.array(*[F.lit(f"2024-06-1{d}") for d in (5, 6, 7)])).alias("ingestion_date")
        return materialize(df.select("*", days), name)

    return marts.player_stats_wide(daily(src.silver_batting, "batting"), daily(src.silver_bowling, "bowling"), by="ingestion_date")


@query(
    "replicate",
    """select p_partkey, p_name, salt::integer as salt from part, unnest(range(0, 10)) t(salt)""",
)
def replicate(src):
    return joins.replicate(src["part"].select("p_partkey", "p_name"), 10)


_ITEM = ["k", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]


def _first_item(order: str) -> str:
    return with_tables(
        "select k, strftime(l_shipdate, '%Y-%m-%d') as ship_day, l_orderkey, l_linenumber, l_suppkey, "
        f"l_quantity, l_extendedprice from ({ctes.first_row('skewed', _ITEM, ['k'], order)})",
        "skewed",
    )


def _items(src):
    return inputs.skewed(src["lineitem"]).select(*_ITEM)


def _with_day(df):
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day")
    return df.select("k", day, *_ITEM[2:])


@query("dedupe_earliest", _first_item("l_shipdate asc nulls last"))
def dedupe_earliest(src):
    return _with_day(dedupe.dedupe_earliest(_items(src), ["k"], "l_shipdate"))


@query("dedupe_max", _first_item("l_quantity desc nulls last"))
def dedupe_max(src):
    return _with_day(dedupe.dedupe_max(_items(src), ["k"], "l_quantity"))


# Squarings of the correlations: 4,096 steps of power iteration.
_SQUARINGS = 12
_FEATURES = ["runs", "average", "strike_rate", "fours", "sixes", "hundreds", "fifties"]


def _refit_sql() -> str:
    """The weights by squaring the correlation matrix, until the largest eigenvalue alone is left."""
    numbers = ", ".join(f"case when abs({f}::double) < 'inf'::double then {f}::double else 0 end as {f}" for f in _FEATURES)
    pairs = " union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as r from numbers" for a in _FEATURES for b in _FEATURES)
    infinite = " union all ".join(f"select '{f}' as feature, count(*) filter (abs({f}::double) = 'inf'::double) as undefined from stg_batting" for f in _FEATURES)
    squared = ", ".join(
        f"""power_{i + 1} as materialized (select a, b, s / max(abs(s)) over () as r
          from (select x.a, y.b, sum(x.r * y.r) as s from power_{i} x join power_{i} y on x.b = y.a group by x.a, y.b))"""
        for i in range(_SQUARINGS)
    )
    return f"""select feature, weight, undefined from (
        with numbers as materialized (select {numbers} from stg_batting), power_0 as materialized ({pairs}), {squared}
        select a as feature, round(r / sqrt(sum(r * r) over ()), 6) as weight from power_{_SQUARINGS} where b = 'runs')
      join ({infinite}) using (feature)"""


@query("refit_weights", with_tables(_refit_sql(), "stg_batting"))
def refit_weights(src):
    fitted = refit.refit_weights(src.stg_batting, _FEATURES, positive="runs")
    return fitted.select("feature", F.round("weight", 6).alias("weight"), "undefined")
