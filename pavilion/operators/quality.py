"""Data-quality gates: row checks, null ratios, schema, uniqueness, contracts, quarantine.

Every row-level check of a table runs in one aggregate over one scan. Reports are
DataFrames with one row per check; only such reports ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.config import GateRule
from pavilion.operators.columns import quoted

LAYERS = ("row_count", "null_ratio", "schema")


class QualityGateFailure(RuntimeError):
    """At least one table failed its gate; the message lists every failed check."""


# ---------------------------------------------------------------- declarations


@dataclass(frozen=True)
class FieldRule:
    """What a column must satisfy. Bounds and length apply to non-null values only."""

    name: str
    dtype: T.DataType | None = None
    required: bool = False
    ge: Any = None
    gt: Any = None
    le: Any = None
    min_length: int | None = None
    unique: bool = False


@dataclass(frozen=True)
class RowRule:
    """A condition over several columns; null counts as fulfilled."""

    name: str
    columns: tuple[str, ...]
    holds: Any  # callable returning a Column


@dataclass(frozen=True)
class Contract:
    """Rules of one table. Columns without a rule are allowed."""

    table: str
    fields: tuple[FieldRule, ...]
    rows: tuple[RowRule, ...] = ()
    may_be_all_null: frozenset[str] = field(default_factory=frozenset)


@dataclass(frozen=True)
class Check:
    """One row-level condition; ``fails`` is true on offending rows and never null."""

    name: str
    column: str
    fails: Column


def _broken(condition: Column) -> Column:
    return F.coalesce(~condition, F.lit(False))


def field_checks(rule: FieldRule, is_double: bool = False) -> list[Check]:
    """Row-level checks of one column. NaN fails any bound; infinity is a value."""
    value = F.col(quoted(rule.name))
    checks = []
    if rule.required:
        checks.append(Check("not_null", rule.name, value.isNull()))
    nan = F.coalesce(F.isnan(value), F.lit(False)) if is_double else F.lit(False)
    for name, bound, condition in (
        ("ge", rule.ge, lambda b: value >= b),
        ("gt", rule.gt, lambda b: value > b),
        ("le", rule.le, lambda b: value <= b),
    ):
        if bound is not None:
            checks.append(Check(name, rule.name, nan | _broken(condition(F.lit(bound)))))
    if rule.min_length is not None:
        checks.append(Check("min_length", rule.name, _broken(F.length(value) >= rule.min_length)))
    return checks


def contract_checks(contract: Contract, df: DataFrame) -> list[Check]:
    """All row-level checks of a contract whose columns the frame has."""
    types = {f.name: f.dataType for f in df.schema.fields}
    checks: list[Check] = []
    for rule in contract.fields:
        if rule.name in types:
            checks += field_checks(rule, isinstance(types[rule.name], (T.DoubleType, T.FloatType)))
    for row in contract.rows:
        if all(c in types for c in row.columns):
            checks.append(Check(row.name, ",".join(row.columns), _broken(row.holds())))
    return checks


# ------------------------------------------------------------- one-pass counting


def report_rows(aggregated: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn the columns of a one-row aggregate into report rows."""
    return aggregated.select(F.inline(F.array(*rows)))


def _value_counts(df: DataFrame) -> list[Column]:
    """Row count ``n`` and the number of values ``v<i>`` of each column; NaN is no value."""
    values = [
        f"count({f'nanvl({quoted(c)}, null)' if dtype in ('double', 'float') else quoted(c)}) as v{i}"
        for i, (c, dtype) in enumerate(df.dtypes)
    ]
    return [F.expr("count(1) as n"), *map(F.expr, values)]


def _null_ratio(i: int) -> Column:
    """Share of nulls in column ``i``; null on an empty frame."""
    return F.expr(f"if(n = 0, null, (n - v{i}) / n)")


def null_ratios(df: DataFrame) -> DataFrame:
    """(column_name, null_ratio) for every column, from one aggregate; null ratio on an empty frame."""
    rows = [
        F.struct(F.lit(c).alias("column_name"), _null_ratio(i).alias("null_ratio"))
        for i, c in enumerate(df.columns)
    ]
    return report_rows(df.agg(*_value_counts(df)), rows)


def null_ratio_gate(
    df: DataFrame, max_ratio: float, may_be_all_null: Iterable[str] = ()
) -> DataFrame:
    """Null ratio per column with its verdict: ``ok``, ``all_null_allowed``, ``failed`` or ``empty``."""
    ratio = F.col("null_ratio")
    status = (
        F.when(ratio.isNull(), "empty")
        .when(ratio <= max_ratio, "ok")
        .when((ratio == 1.0) & F.col("column_name").isin(*may_be_all_null), "all_null_allowed")
        .otherwise("failed")
    )
    return null_ratios(df).withColumn("status", status)


def count_violations(df: DataFrame, checks: Sequence[Check], table: str = "table") -> DataFrame:
    """(table_name, column_name, check_name, violations) for all checks, from one scan."""
    measures = [F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)]
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.name).alias("check_name"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return report_rows(df.agg(*measures), rows)


def schema_diff(actual: T.StructType, contract: Contract) -> list[tuple[str, str, str, str]]:
    """(column, expected type, actual type, status) per typed rule; types are never coerced."""
    types = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for rule in contract.fields:
        if rule.dtype is None:
            continue
        expected, found = rule.dtype.simpleString(), types.get(rule.name)
        status = "missing" if found is None else "ok" if found == expected else "wrong_type"
        rows.append((rule.name, expected, found or "", status))
    return rows


def schema_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Schema comparison with the number of values each typed column holds."""
    diff = schema_diff(df.schema, contract)
    present = set(df.columns)
    measures = [
        (F.count(F.col(quoted(c))) if c in present else F.lit(0).cast("bigint")).alias(f"v{i}")
        for i, (c, *_) in enumerate(diff)
    ]
    names = ("column_name", "expected_type", "actual_type", "status")
    rows = [
        F.struct(
            *[F.lit(text).alias(name) for name, text in zip(names, entry, strict=True)],
            F.col(f"v{i}").alias("values"),
        )
        for i, entry in enumerate(diff)
    ]
    return report_rows(df.agg(*measures), rows)


# ------------------------------------------------------------------------- gates


def gate_report(
    df: DataFrame, contract: Contract, rule: GateRule, fixtures: bool = False
) -> DataFrame:
    """Every check of the three layers for one table, from one scan.

    Columns: table_name, layer, column_name, check_name, observed, allowed, passed.
    ``observed`` is a row count, a null ratio or a number of violations.
    """
    needed = rule.rows_needed(fixtures)
    checks = contract_checks(contract, df)
    measures = _value_counts(df)
    measures += [F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)]

    def entry(layer: str, column: str, check: str, observed: Column, allowed: float, ok: Column):
        return F.struct(
            F.lit(contract.table).alias("table_name"),
            F.lit(layer).alias("layer"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            observed.cast("double").alias("observed"),
            F.lit(float(allowed)).alias("allowed"),
            ok.alias("passed"),
        )

    rows = [entry("row_count", "", "min_rows", F.col("n"), needed, F.col("n") >= needed)]
    for i, c in enumerate(df.columns):
        ratio = _null_ratio(i)
        ok = ratio <= rule.max_null_ratio
        if c in contract.may_be_all_null:
            ok = ok | (ratio == 1.0)
        rows.append(
            entry("null_ratio", c, "max_null_ratio", ratio, rule.max_null_ratio, F.coalesce(ok, F.lit(False)))
        )
    for name, _, _, status in schema_diff(df.schema, contract):
        bad = F.lit(0 if status == "ok" else 1)
        rows.append(entry("schema", name, "type", bad, 0, F.lit(status == "ok")))
    for i, c in enumerate(checks):
        rows.append(entry("schema", c.column, c.name, F.col(f"c{i}"), 0, F.col(f"c{i}") == 0))
    return report_rows(df.agg(*measures), rows)


def first_failing_layer(report: DataFrame) -> list[str]:
    """Messages of the first failing layer of a one-table report; empty when it passed."""
    failed = report.where(~F.col("passed")).collect()  # at most one row per check
    for layer in LAYERS:
        found = [r for r in failed if r["layer"] == layer]
        if found:
            return [
                f"{r['table_name']}: {layer} {r['column_name']} {r['check_name']}: "
                f"observed {'nothing' if r['observed'] is None else format(r['observed'], 'g')}, "
                f"allowed {r['allowed']:g}"
                for r in found
            ]
    return []


def validate_table(
    df: DataFrame,
    table: str,
    contracts: Mapping[str, tuple[Contract, GateRule]],
    fixtures: bool = False,
) -> None:
    """Raise ``QualityGateFailure`` with all violations of the first failing layer."""
    if table not in contracts:
        raise ValueError(f"no quality contract for table {table!r}")
    contract, rule = contracts[table]
    messages = first_failing_layer(gate_report(df, contract, rule, fixtures))
    if messages:
        raise QualityGateFailure("\n".join(messages))


def gate_reports(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, tuple[Contract, GateRule]],
    fixtures: bool = False,
) -> DataFrame:
    """The reports of several tables in one frame."""
    unknown = sorted(set(tables) - set(contracts))
    if unknown:
        raise ValueError(f"no quality contract for tables {unknown}")
    reports = [gate_report(df, *contracts[name], fixtures) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def require_reports(reports: Mapping[str, DataFrame]) -> None:
    """Raise once with the violations of the first failing layer of every table's report."""
    failures = ["\n".join(found) for found in map(first_failing_layer, reports.values()) if found]
    if failures:
        raise QualityGateFailure(f"quality gate failed for {len(failures)} table(s):\n" + "\n---\n".join(failures))


def run_gate(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, tuple[Contract, GateRule]],
    fixtures: bool = False,
) -> None:
    """Check all tables, then raise once with the failures of each."""
    failures = []
    for name, df in tables.items():
        try:
            validate_table(df, name, contracts, fixtures)
        except QualityGateFailure as failure:
            failures.append(str(failure))
    if failures:
        raise QualityGateFailure(
            f"quality gate failed for {len(failures)} table(s):\n" + "\n---\n".join(failures)
        )


# ------------------------------------------------------------------- table tests


@dataclass(frozen=True)
class TableTest:
    """A declared test: ``not_null``, ``unique``, ``accepted_values``, ``accepted_range`` or ``references``.

    ``references`` names the table and column in which every value must occur.
    """

    table: str
    column: str
    kind: str
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    where: str | None = None
    to: tuple[str, str] | None = None


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(F.col(quoted(column)).isNull())


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, count) of values that occur more than once; nulls are left out."""
    value = F.col(quoted(column))
    counts = df.where(value.isNotNull()).groupBy(value.alias(column))
    return counts.agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def repeated_keys(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    """(table_name, column_name, check_name, violations): keys that occur more than once in each column.

    All columns are counted in one pass over (column, value); nulls are left out.
    """
    cells = [F.struct(F.lit(i).alias("i"), F.col(quoted(c)).cast("string").alias("v")) for i, c in enumerate(columns)]
    values = df.select(F.inline(F.array(*cells))).where("v is not null")
    repeated = values.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = repeated.agg(*[F.count_if(F.col("i") == i).alias(f"c{i}") for i in range(len(columns))])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit("unique").alias("check_name"), F.col(f"c{i}").alias("violations")
        )
        for i, c in enumerate(columns)
    ]
    return report_rows(counted, rows)


def orphans(df: DataFrame, column: str, other: DataFrame, key: str) -> DataFrame:
    """Rows whose value does not occur in another table's key; nulls are left out."""
    keys = other.select(F.col(quoted(key)).alias("__key")).distinct()
    return df.where(F.col(quoted(column)).isNotNull()).join(keys, F.col(quoted(column)) == F.col("__key"), "left_anti")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[Any]) -> DataFrame:
    """(value, count) of values outside the accepted ones; nulls are left out."""
    value = F.col(quoted(column))
    return (
        df.where(~value.isin(*accepted))
        .groupBy(value.alias(column))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def out_of_range(
    df: DataFrame, column: str, low: Any = None, high: Any = None, where: str | None = None
) -> DataFrame:
    """Rows whose value lies outside the range, among rows that fulfil ``where``."""
    value = F.col(quoted(column))
    bounds = [value < F.lit(low)] if low is not None else []
    bounds += [value > F.lit(high)] if high is not None else []
    rows = df.where(where) if where else df
    return rows.where(reduce(lambda a, b: a | b, bounds, F.lit(False)))


def _row_test(test: TableTest) -> Check:
    value = F.col(quoted(test.column))
    if test.kind == "not_null":
        return Check(test.kind, test.column, value.isNull())
    if test.kind == "accepted_values":
        return Check(test.kind, test.column, _broken(value.isin(*test.values)))
    if test.kind == "accepted_range":
        fails = F.lit(False)
        if test.low is not None:
            fails = fails | _broken(value >= F.lit(test.low))
        if test.high is not None:
            fails = fails | _broken(value <= F.lit(test.high))
        if test.where:
            fails = fails & F.coalesce(F.expr(test.where), F.lit(False))
        return Check(test.kind, test.column, fails)
    raise ValueError(f"unknown test kind {test.kind!r}")


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[TableTest]) -> DataFrame:
    """(table_name, column_name, check_name, violations) for every declared test.

    Row-level tests share one scan per table, and its uniqueness tests, which count the keys that
    occur more than once, one grouped count. A reference test counts the rows without a partner.
    """
    reports = []
    for table in dict.fromkeys(t.table for t in tests):
        df = tables[table]
        mine = [t for t in tests if t.table == table]
        row_tests = [_row_test(t) for t in mine if t.kind not in ("unique", "references")]
        if row_tests:
            reports.append(count_violations(df, row_tests, table))
        unique = [t.column for t in mine if t.kind == "unique"]
        if unique:
            reports.append(repeated_keys(df, unique, table))
        for t in (t for t in mine if t.kind == "references"):
            other, key = t.to
            lost = orphans(df, t.column, tables[other], key).agg(F.count(F.lit(1)).alias("violations"))
            names = (F.lit(x).alias(n) for x, n in ((table, "table_name"), (t.column, "column_name"), (t.kind, "check_name")))
            reports.append(lost.select(*names, "violations"))
    return reduce(DataFrame.unionByName, reports)


def require_tests(tables: Mapping[str, DataFrame], tests: Sequence[TableTest]) -> None:
    """Raise ``QualityGateFailure`` when any declared test has violations."""
    failed = run_tests(tables, tests).where(F.col("violations") > 0).collect()
    if failed:
        raise QualityGateFailure(
            "\n".join(
                f"{r['table_name']}.{r['column_name']}: {r['check_name']}: {r['violations']} violations"
                for r in failed
            )
        )


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, check_name, violations) of a data contract: types, required, bounds, unique.

    A column that is missing or has another type is one violation of its type, whatever the number of
    rows. Its other checks are skipped where it is missing. Two scans: one for rows, one for keys.
    """
    checks = contract_checks(contract, df)
    rows = [
        F.struct(F.lit(c.column).alias("column_name"), F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("violations"))
        for i, c in enumerate(checks)
    ]
    rows += [
        F.struct(F.lit(name).alias("column_name"), F.lit("type").alias("check_name"), F.lit(int(status != "ok")).cast("bigint").alias("violations"))
        for name, _, _, status in schema_diff(df.schema, contract)
    ]
    typed = {r.name for r in contract.fields if r.dtype is not None}
    rows += [
        F.struct(F.lit(r.name).alias("column_name"), F.lit("missing").alias("check_name"), F.lit(1).cast("bigint").alias("violations"))
        for r in contract.fields
        if r.name not in df.columns and r.name not in typed
    ]
    reports = [report_rows(df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)]), rows)] if rows else []
    unique = [r.name for r in contract.fields if r.unique and r.name in df.columns]
    if unique:
        reports.append(repeated_keys(df, unique).drop("table_name"))
    if not reports:
        raise ValueError(f"the contract of {contract.table!r} has no rules")
    return reduce(DataFrame.unionByName, reports)


# -------------------------------------------------------------------- quarantine


def with_reasons(df: DataFrame, checks: Sequence[Check], name: str = "reasons") -> DataFrame:
    """The frame with an array of the names of the checks each row fails."""
    failed = [F.when(c.fails, F.lit(f"{c.column}:{c.name}")) for c in checks]
    return df.withColumn(name, F.array_compact(F.array(*failed)))


def sound_document() -> Check:
    """Fails for documents that ``sources.tables.parsed_documents`` could not read."""
    return Check("json", "document", F.col("corrupt").isNotNull())


def quarantine(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with their reasons. Together they are the input."""
    marked = with_reasons(df, checks)
    valid = marked.where(F.size("reasons") == 0).drop("reasons")
    return valid, marked.where(F.size("reasons") > 0)
