"""Profiles of a table's parts, which add up.

A profile has a row for every column and every check of a contract: row count, values, least and greatest value, a
sketch of the distinct values, violations. It is made in one scan of the new part only and stored; the profiles of
all parts, merged, say about the whole table what a scan of it would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.config import GateRule
from pavilion.operators.columns import quoted
from pavilion.operators.quality import Contract, contract_checks, report_rows, schema_diff

_EDGE = "struct<whole: bigint, number: double, text: string>"
# Fixed value: five standard errors of a sketch with 2**12 places, about 1.04 / sqrt(places) each.
_SURE = 1 + 5 * 1.04 / 2**6


def _edge(value: Column, dtype: T.DataType) -> Column:
    """A value in the field that keeps its order: longs, doubles, or everything else as text."""
    empty = F.lit(None)
    if isinstance(dtype, T.IntegralType):
        return F.struct(value.alias("whole"), empty.alias("number"), empty.alias("text")).cast(_EDGE)
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return F.struct(empty.alias("whole"), value.alias("number"), empty.alias("text")).cast(_EDGE)
    return F.struct(empty.alias("whole"), empty.alias("number"), value.cast("string").alias("text")).cast(_EDGE)


def profile(df: DataFrame, contract: Contract) -> DataFrame:
    """(table_name, column_name, check_name, n_rows, amount, low, high, distinct) of a frame, from one scan.

    A row without ``check_name`` is a column's: ``amount`` counts its values (NaN is none), ``low`` and ``high`` are its least and
    greatest one, and ``distinct`` is a sketch of its values. In a check's row ``amount`` counts violations.
    Columns that hold arrays, maps or structs have counts only.
    """
    checks = contract_checks(contract, df)
    measures = [F.count(F.lit(1)).alias("n")]
    rows = []

    def row(column: str, check: str | None, amount: str, low: Column, high: Column, distinct: Column) -> Column:
        return F.struct(
            F.lit(contract.table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(check).cast("string").alias("check_name"),
            F.col("n").alias("n_rows"), F.col(amount).alias("amount"), low.alias("low"), high.alias("high"), distinct.alias("distinct"),
        )

    none, no_sketch = F.lit(None).cast(_EDGE), F.lit(None).cast("binary")
    for i, field in enumerate(df.schema.fields):
        value = F.col(quoted(field.name))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None))
        measures.append(F.count(value).alias(f"v{i}"))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            rows.append(row(field.name, None, f"v{i}", none, none, no_sketch))
            continue
        measures += [F.min(value).alias(f"l{i}"), F.max(value).alias(f"h{i}"), F.hll_sketch_agg(value.cast("string")).alias(f"d{i}")]
        low, high = (F.when(F.col(f"v{i}") > 0, _edge(F.col(f"{side}{i}"), field.dataType)) for side in "lh")
        rows.append(row(field.name, None, f"v{i}", low, high, F.col(f"d{i}")))
    for i, check in enumerate(checks):
        measures.append(F.count_if(check.fails).alias(f"c{i}"))
        rows.append(row(check.column, check.name, f"c{i}", none, none, no_sketch))
    return report_rows(df.agg(*measures), rows)


def merged(profiles: DataFrame) -> DataFrame:
    """The profile of all parts together; further columns, such as a date, are left out."""
    return profiles.groupBy("table_name", "column_name", "check_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("amount").alias("amount"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def profile_report(profiled: DataFrame, schema: T.StructType, contract: Contract, rule: GateRule, fixtures: bool = False) -> DataFrame:
    """What ``quality.gate_report`` says about the rows that were profiled, without reading them."""
    needed = rule.rows_needed(fixtures)
    n, amount, column = F.col("n_rows"), F.col("amount"), F.col("column_name")
    ratio = F.when(n > 0, (n - amount) / n)
    allowed_null = (ratio <= rule.max_null_ratio) | ((ratio == 1.0) & column.isin(*contract.may_be_all_null))

    def entry(layer: str, column: Column, check: Column, observed: Column, allowed: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(contract.table).alias("table_name"), F.lit(layer).alias("layer"), column.alias("column_name"), check.alias("check_name"),
            observed.cast("double").alias("observed"), allowed.cast("double").alias("allowed"), passed.alias("passed"),
        )

    is_column = F.col("check_name").isNull()
    nulls = entry("null_ratio", column, F.lit("max_null_ratio"), ratio, F.lit(rule.max_null_ratio), F.coalesce(allowed_null, F.lit(False)))
    broken = entry("schema", column, F.col("check_name"), amount, F.lit(0), amount == 0)
    rows = profiled.select(F.inline(F.array(F.when(is_column, nulls).otherwise(broken))))
    whole = profiled.agg(F.coalesce(F.max("n_rows"), F.lit(0)).alias("n"))
    types = [
        entry("schema", F.lit(name), F.lit("type"), F.lit(int(status != "ok")), F.lit(0), F.lit(status == "ok"))
        for name, _, _, status in schema_diff(schema, contract)
    ]
    count = entry("row_count", F.lit(""), F.lit("min_rows"), F.col("n"), F.lit(needed), F.col("n") >= needed)
    return rows.unionByName(whole.select(F.inline(F.array(count, *types))))


def uniqueness(profiled: DataFrame) -> DataFrame:
    """(column_name, amount, about_distinct, repeated) of profiled columns.

    ``repeated`` is true where even a sketch that errs by five standard errors shows fewer distinct values than values.
    Where it is false the column may be unique, and ``quality.repeated_keys`` has to tell.
    """
    about = F.hll_sketch_estimate("distinct")
    columns = profiled.where("check_name is null and distinct is not null")
    return columns.select("column_name", "amount", about.alias("about_distinct"), (about * _SURE < F.col("amount")).alias("repeated"))
