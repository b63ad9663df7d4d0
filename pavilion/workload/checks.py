"""Queries over the data-quality operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from pavilion.config import GateRule
from pavilion.operators import profiles, quality
from pavilion.operators.quality import FieldRule
from pavilion.plans import contracts, marts, staging
from pavilion.session import materialize, new_folder
from pavilion.sources import tables
from pavilion.workload import inputs
from pavilion.workload.ctes import SILVER_BATTING, SILVER_BOWLING, with_tables
from pavilion.workload.registry import query
from pavilion.workload.rules import LAST_YEAR, RANKED, ROLES

_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "ts"]


def _ratio(column: str) -> str:
    return f"count(*) filter ({column} is null)::double / count(*)"


def _ratios(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, {_ratio(c)} as null_ratio from {table}" for c in columns
    )


@query("null_ratios", with_tables(_ratios("typed_batting", SILVER_BATTING), "typed_batting"))
def null_ratios(src):
    return quality.null_ratios(src.typed_batting)


@query(
    "null_ratio_gate",
    with_tables(
        f"""select *, case when null_ratio <= 0.05 then 'ok'
          when null_ratio = 1 and column_name in ('country_tag', 'fours') then 'all_null_allowed'
          else 'failed' end as status from ({_ratios(
            "(select *, null::varchar as country_tag, null::varchar as other from gap_events)",
            [*_EVENT_COLUMNS, "country_tag", "other"])})""",
        "gap_events",
    ),
)
def null_ratio_gate(src):
    events = inputs.events_with_gaps(src["events"]).withColumns(
        {"country_tag": F.lit(None).cast("string"), "other": F.lit(None).cast("string")}
    )
    return quality.null_ratio_gate(events, 0.05, ["country_tag", "fours"])


@query(
    "schema_diff",
    """select 'event_id' as column_name, 'bigint' as expected_type, 'bigint' as actual_type, 'ok' as status,
      count(event_id) as values from events
    union all select 'user_id', 'string', 'bigint', 'wrong_type', count(user_id) from events
    union all select 'value', 'double', 'double', 'ok', count(value) from events
    union all select 'amount', 'double', '', 'missing', 0 from events where event_id = 0""",
)
def schema_diff(src):
    rules = (
        FieldRule("event_id", T.LongType()),
        FieldRule("user_id", T.StringType()),
        FieldRule("value", T.DoubleType()),
        FieldRule("amount", T.DoubleType()),
    )
    return quality.schema_report(src["events"], quality.Contract("events", rules))


def _violations(table: str, checks: list[tuple[str, str, str]]) -> str:
    """One row per (column, check, failing condition)."""
    return " union all ".join(
        f"""select '{column}' as column_name, '{check}' as check_name,
        count(*) filter ({fails}) as violations from {table}"""
        for column, check, fails in checks
    )


def _count(src, rules, rows=()):
    df = src.typed_batting
    checks = quality.contract_checks(quality.Contract("batting", tuple(rules), tuple(rows)), df)
    return quality.count_violations(df, checks).drop("table_name")


@query(
    "check_not_null",
    with_tables(
        _violations(
            "typed_batting",
            [("player", "not_null", "player is null"), ("runs", "not_null", "runs is null")],
        ),
        "typed_batting",
    ),
)
def check_not_null(src):
    return _count(src, [FieldRule("player", required=True), FieldRule("runs", required=True)])


@query(
    "check_range",
    with_tables(
        _violations(
            "typed_batting",
            [
                ("career_start_year", "ge", "career_start_year < 1996"),
                ("career_start_year", "le", "career_start_year > 2000"),
                ("matches", "gt", "matches <= 8"),
                ("strike_rate", "le", "strike_rate > 100"),
                ("average", "ge", "average < 5"),
                ("runs", "le", "runs > 3000"),
            ],
        ),
        "typed_batting",
    ),
)
def check_range(src):
    rules = [
        FieldRule("career_start_year", ge=1996, le=2000),
        FieldRule("matches", gt=8),
        FieldRule("strike_rate", le=100.0),
        FieldRule("average", ge=5.0),
        FieldRule("runs", le=3000),
    ]
    return _count(src, rules)


@query(
    "check_str_len",
    with_tables(
        _violations(
            "typed_batting",
            [
                ("player", "min_length", "length(player) < 18"),
                ("country_tag", "min_length", "length(country_tag) < 9"),
            ],
        ),
        "typed_batting",
    ),
)
def check_str_len(src):
    return _count(src, [FieldRule("player", min_length=18), FieldRule("country_tag", min_length=9)])


@query(
    "check_span",
    with_tables(
        _violations(
            "typed_batting",
            [
                (
                    "career_start_year,career_end_year",
                    "career_span_valid",
                    "career_end_year < career_start_year",
                ),
                ("career_start_year,career_end_year", "long_career", "career_end_year < career_start_year + 6"),
            ],
        ),
        "typed_batting",
    ),
)
def check_span(src):
    long_career = quality.RowRule(
        "long_career",
        ("career_start_year", "career_end_year"),
        lambda: F.col("career_end_year") >= F.col("career_start_year") + 6,
    )
    return _count(src, [], [contracts.SPAN_RULE, long_career])


# ------------------------------------------------------------------------- gates

_BAT_TYPES = "player country_tag career_start_year career_end_year matches innings runs average strike_rate hundreds fifties"
_BOWL_TYPES = (
    "player country_tag career_start_year career_end_year matches innings balls_bowled runs_conceded "
    "wickets bowling_average economy_rate bowling_strike_rate"
)
_YEARS = [
    ("career_start_year", "ge", "career_start_year < 1860"),
    ("career_start_year", "le", f"career_start_year > {LAST_YEAR}"),
    ("career_end_year", "ge", "career_end_year < 1860"),
    ("career_end_year", "le", f"career_end_year > {LAST_YEAR}"),
]
_PLAYER_CHECKS = [
    ("player", "not_null", "player is null"),
    ("player", "min_length", "length(player) < 1"),
    *_YEARS,
]
_BAT_CHECKS = [
    *_PLAYER_CHECKS,
    *[(c, "ge", f"{c} < 0") for c in ("matches", "innings")],
    ("runs", "not_null", "runs is null"),
    ("runs", "ge", "runs < 0"),
    ("runs", "le", "runs > 25000"),
    ("average", "ge", "average < 0"),
    ("strike_rate", "ge", "strike_rate < 0"),
    ("strike_rate", "le", "strike_rate > 500"),
    *[(c, "ge", f"{c} < 0") for c in ("hundreds", "fifties")],
    ("career_start_year,career_end_year", "career_span_valid", "career_end_year < career_start_year"),
]
_BOWL_CHECKS = [
    *_PLAYER_CHECKS,
    *[(c, "ge", f"{c} < 0") for c in ("matches", "innings", "balls_bowled", "runs_conceded")],
    ("wickets", "not_null", "wickets is null"),
    ("wickets", "gt", "wickets <= 0"),
    ("wickets", "le", "wickets > 700"),
    ("bowling_average", "ge", "bowling_average < 0"),
    ("economy_rate", "ge", "economy_rate < 0"),
    ("economy_rate", "le", "economy_rate > 15"),
    ("bowling_strike_rate", "ge", "bowling_strike_rate < 0"),
]
_OPTIONAL = ", ".join(f"'{c}'" for c in sorted(contracts.MAY_BE_ALL_NULL))


def _gate_sql(name: str, table: str, columns: list[str], typed: str, checks, min_rows: int, max_null: float):
    parts = [
        f"""select '{name}' as table_name, 'row_count' as layer, '' as column_name, 'min_rows' as check_name,
        count(*)::double as observed, {min_rows}::double as allowed, count(*) >= {min_rows} as passed
        from {table}"""
    ]
    parts += [
        f"""select '{name}', 'null_ratio', column_name, 'max_null_ratio', null_ratio, {max_null}::double,
        null_ratio <= {max_null}::double or (null_ratio = 1 and column_name in ({_OPTIONAL}))
        from ({_ratios(table, columns)})"""
    ]
    parts += [f"select '{name}', 'schema', '{c}', 'type', 0, 0, true" for c in typed.split()]
    parts += [
        f"""select '{name}', 'schema', column_name, check_name, violations::double, 0, violations = 0
        from ({_violations(table, checks)})"""
    ]
    return " union all ".join(parts)


_GATE_BAT = _gate_sql("batting", "silver_batting", SILVER_BATTING, _BAT_TYPES, _BAT_CHECKS, 2000, 0.02)
_GATE_BOWL = _gate_sql("bowling", "silver_bowling", SILVER_BOWLING, _BOWL_TYPES, _BOWL_CHECKS, 50, 0.02)


def _contracts():
    return {
        "batting": (contracts.batting_contract(last_year=LAST_YEAR), GateRule(2000)),
        "bowling": (
            contracts.bowling_contract(last_year=LAST_YEAR),
            GateRule(1500, fixture_min_rows=50),
        ),
    }


@query("profile_gate", with_tables(_GATE_BAT, "silver_batting"))
def profile_gate(src):
    """The gate's report from the profiles of three parts, which are written and merged; the table is not read again."""
    contract, rule = _contracts()["batting"]
    rows = materialize(src.silver_batting, "batting")
    root = new_folder(src.spark, "profiles")
    for i in range(3):
        part = rows.where(F.pmod(F.xxhash64("player"), F.lit(3)) == i)
        tables.write_partition(profiles.profile(part, contract), root, dt.date(2024, 6, 1 + i))
    merged = profiles.merged(tables.read_table(src.spark, root))
    return profiles.profile_report(merged, rows.schema, contract, rule)


@query("gate_report", with_tables(_GATE_BAT, "silver_batting"))
def gate_report(src):
    return quality.gate_report(src.silver_batting, *_contracts()["batting"])


@query(
    "run_gate", with_tables(f"{_GATE_BAT} union all {_GATE_BOWL}", "silver_batting", "silver_bowling")
)
def run_gate(src):
    frames = {"batting": src.silver_batting, "bowling": src.silver_bowling}
    return quality.gate_reports(frames, _contracts(), fixtures=True)


# ------------------------------------------------------------------- table tests


@query(
    "test_unique",
    "select l_orderkey, count(*) as n_rows from lineitem group by l_orderkey having count(*) > 1",
)
def test_unique(src):
    return quality.duplicate_keys(src["lineitem"], "l_orderkey")


@query(
    "test_accepted",
    """select o_orderpriority, count(*) as n_rows from orders
    where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by o_orderpriority""",
)
def test_accepted(src):
    return quality.unaccepted_values(
        src["orders"], "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    )


@query(
    "test_range",
    """select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_returnflag = 'A' and (l_quantity < 5 or l_quantity > 45)""",
)
def test_range(src):
    rows = quality.out_of_range(src["lineitem"], "l_quantity", 5, 45, where="l_returnflag = 'A'")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "test_not_null",
    with_tables("select event_id, event_type from gap_events where value is null", "gap_events"),
)
def test_not_null(src):
    rows = quality.null_rows(inputs.events_with_gaps(src["events"]), "value")
    return rows.select("event_id", "event_type")


def _tests_sql() -> str:
    tables = {"mart_top_batsmen": "batsmen", "mart_top_bowlers": "bowlers", "fact_career_stats": "fact_long"}
    bounds = {
        ("stg_batting", "runs"): "runs < 0 or runs > 25000",
        ("stg_batting", "strike_rate"): "strike_rate < 0 or strike_rate > 500",
        ("stg_bowling", "wickets"): "wickets < 1 or wickets > 700",
    }
    accepted = {
        "player_role": "'batsman', 'bowler', 'all_rounder'",
        "metric_name": "'matches', 'runs', 'batting_average', 'strike_rate', 'hundreds', 'fifties', "
        "'fours', 'sixes', 'wickets', 'bowling_average', 'economy_rate', 'bowling_strike_rate'",
    }
    declared = {
        "batting": ["player:n", "runs:n"],
        "bowling": ["player:n", "wickets:n"],
        "stg_batting": ["player:n", "runs:nr", "strike_rate:r"],
        "stg_bowling": ["player:n", "wickets:nr"],
        "dim_player": ["player:nu", "player_role:na"],
        "fact_career_stats": ["player:n", "metric_name:na", "metric_value:n"],
        "mart_top_batsmen": ["rank:nu", "player:nu", "pca_score:n"],
        "mart_top_bowlers": ["rank:nu", "player:nu", "pca_score:n"],
    }
    tables |= {"batting": "silver_batting", "bowling": "silver_bowling"}
    parts = []
    for table, columns in declared.items():
        base = tables.get(table, table)
        if table.startswith("mart_"):
            base = f"(select row_number() over (order by pca_score desc) as rank, * from {base})"
        for column, kinds in (c.split(":") for c in columns):
            for kind in kinds:
                head = f"select '{table}' as table_name, '{column}' as column_name"
                if kind == "u":
                    parts.append(
                        f"""{head}, 'unique' as check_name, count(*) as violations from (select {column}
                        from {base} where {column} is not null group by {column} having count(*) > 1)"""
                    )
                    continue
                check, fails = {
                    "n": ("not_null", f"{column} is null"),
                    "r": ("accepted_range", bounds.get((table, column))),
                    "a": ("accepted_values", f"{column} not in ({accepted.get(column)})"),
                }[kind]
                parts.append(
                    f"{head}, '{check}' as check_name, count(*) filter ({fails}) as violations from {base}"
                )
    return " union all ".join(parts)


@query(
    "test_report",
    with_tables(
        _tests_sql(), "silver_batting", "silver_bowling", "dim_player", "batsmen", "bowlers", "fact_long"
    ),
)
def test_report(src):
    # Tables that several tests read are written once, as the daily job does.
    batting = materialize(src.silver_batting, "batting")
    bowling = materialize(src.silver_bowling, "bowling")
    stg_batting, stg_bowling = staging.stg_batting(batting), staging.stg_bowling(bowling)
    dim = materialize(marts.dim_player(stg_batting, stg_bowling, ROLES), "dim_player")
    tables = {
        "batting": batting,
        "bowling": bowling,
        "stg_batting": stg_batting,
        "stg_bowling": stg_bowling,
        "dim_player": dim,
        "fact_career_stats": marts.fact_career_stats(stg_batting, stg_bowling),
        "mart_top_batsmen": materialize(marts.mart_top_batsmen(dim, RANKED), "mart"),
        "mart_top_bowlers": materialize(marts.mart_top_bowlers(dim, RANKED), "mart"),
    }
    return quality.run_tests(tables, [*contracts.source_tests(), *contracts.model_tests()])


def _events_contract(src):
    return contracts.transaction_contract(
        "event_id",
        "user_id",
        "value",
        "ts",
        min_amount=1.0,
        id_type=T.LongType(),
        timestamp_type=src["events"].schema["ts"].dataType,
    )


@query(
    "contract_report",
    _violations(
        "events",
        [
            ("event_id", "not_null", "event_id is null"),
            ("user_id", "not_null", "user_id is null"),
            ("value", "not_null", "value is null"),
            ("value", "ge", "value < 1.0"),
            ("ts", "not_null", "ts is null"),
            *[(c, "type", "false") for c in ("event_id", "user_id", "value", "ts")],
        ],
    )
    + """ union all select 'event_id', 'unique', count(*) from
      (select event_id from events group by event_id having count(*) > 1)""",
)
def contract_report(src):
    return quality.contract_report(src["events"], _events_contract(src))


@query(
    "contract_report_missing",
    _violations("events", [("user_id", "not_null", "user_id is null"), ("ts", "not_null", "ts is null")])
    + """ union all select * from (values ('event_id', 'type', 1), ('user_id', 'type', 0), ('value', 'type', 1),
      ('ts', 'type', 0)) t""",
)
def contract_report_missing(src):
    """The unique column and a bounded one are missing; each is one violation."""
    return quality.contract_report(src["events"].drop("event_id", "value"), _events_contract(src))


@query(
    "contract_report_empty",
    """select * from (values ('event_id', 'not_null', 0), ('user_id', 'not_null', 0), ('ts', 'not_null', 0),
      ('event_id', 'type', 0), ('user_id', 'type', 0), ('value', 'type', 1), ('ts', 'type', 0),
      ('event_id', 'unique', (select count(*) from events where false))) t(column_name, check_name, violations)""",
)
def contract_report_empty(src):
    """No rows at all, and a missing column."""
    nothing = src["events"].where("event_id < 0").drop("value")
    return quality.contract_report(nothing, _events_contract(src))


_REASONS = """concat_ws(',', case when player is null then 'player:not_null' end,
    case when runs is null then 'runs:not_null' end,
    case when runs > 3000 then 'runs:le' end,
    case when average < 5 then 'average:ge' end)"""


def _quarantine_checks(src):
    df = src.typed_batting
    rules = (
        FieldRule("player", required=True),
        FieldRule("runs", required=True, le=3000),
        FieldRule("average", ge=5.0),
    )
    return df, quality.contract_checks(quality.Contract("batting", rules), df)


@query(
    "quarantine",
    with_tables(
        f"""select player, career_start_year, matches, runs, average, reasons from
        (select *, {_REASONS} as reasons from typed_batting) where reasons <> ''""",
        "typed_batting",
    ),
)
def quarantine(src):
    _, invalid = quality.quarantine(*_quarantine_checks(src))
    reasons = F.concat_ws(",", "reasons").alias("reasons")
    return invalid.select("player", "career_start_year", "matches", "runs", "average", reasons)


@query(
    "quarantine_valid",
    with_tables(
        f"""select player, career_start_year, matches, runs, average from
        (select *, {_REASONS} as reasons from typed_batting) where reasons = ''""",
        "typed_batting",
    ),
)
def quarantine_valid(src):
    valid, _ = quality.quarantine(*_quarantine_checks(src))
    return valid.select("player", "career_start_year", "matches", "runs", "average")
