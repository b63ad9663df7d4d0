"""Column-level reshaping: names, presence and types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.functions.numbers import safe_double


def quoted(name: str) -> str:
    """Name as a column reference, for headers such as ``100`` or ``a.b``."""
    return "`" + name.replace("`", "``") + "`"


def computed_once(value: Column) -> Column:
    """The same value behind a one-element explode, for expensive parsing.

    Catalyst copies a projected expression into every filter it pushes down, which
    would parse each row several times; it does not look into a generator.
    """
    return F.explode(F.array(value))


def drop_index_columns(df: DataFrame, prefixes: Sequence[str] = ("Unnamed", "_c")) -> DataFrame:
    """Drop columns left by a saved row index; ``_c<n>`` is Spark's name for a blank header."""

    def is_index(name: str) -> bool:
        for prefix in prefixes:
            if name.startswith(prefix):
                return prefix != "_c" or name[2:].isdigit()
        return False

    return df.select(*[quoted(c) for c in df.columns if not is_index(c)])


def rename_known(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present, exact spelling only."""
    return df.selectExpr(*[f"{quoted(c)} as {quoted(aliases.get(c, c))}" for c in df.columns])


def first_present(df: DataFrame, names: Sequence[str]) -> str:
    """First of ``names`` that the frame has."""
    for name in names:
        if name in df.columns:
            return name
    raise KeyError(f"none of {list(names)} in {df.columns}")


def complete_schema(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Exactly the schema's columns; absent ones become their default or a typed null."""
    absent = {f.name: f.dataType for f in schema.fields if f.name not in df.columns}
    filled = df.withColumns(
        {name: F.lit((defaults or {}).get(name)).cast(dtype) for name, dtype in absent.items()}
    )
    typed = [
        f"cast({quoted(f.name)} as {f.dataType.simpleString()}) as {quoted(f.name)}"
        for f in schema.fields
    ]
    return filled.selectExpr(*typed)


def coerce_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn the named text columns into doubles, junk into null; other columns stay as they are."""
    wanted = set(names)
    return df.select(
        *[
            (safe_double(F.col(quoted(c))).alias(c) if c in wanted else F.col(quoted(c)))
            for c in df.columns
        ]
    )
