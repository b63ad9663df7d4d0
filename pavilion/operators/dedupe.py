"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pavilion.operators.columns import quoted

_ROW = "__row_in_key"


def keep_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """First row of each key in the given SQL order; null keys equal each other.

    All remaining columns follow as tie-breakers, so the kept row is the same on
    every run. The filter on ``row_number`` makes Spark cut each key to one row
    per input partition before the shuffle, so a hot key stays small.
    """
    ties = [f"{quoted(c)} asc nulls last" for c in df.columns if c not in keys]
    by, first = ", ".join(map(quoted, keys)), ", ".join([*order, *ties])
    numbered = df.selectExpr("*", f"row_number() over (partition by {by} order by {first}) as {_ROW}")
    return numbered.where(F.col(_ROW) == 1).drop(_ROW)


def dedupe_earliest(
    df: DataFrame, keys: Sequence[str], by: str, latest: str | None = None
) -> DataFrame:
    """Row with the smallest ``by``, nulls last; ``latest`` prefers newer rows on a tie."""
    order = [f"{quoted(by)} asc nulls last"]
    if latest and latest in df.columns:
        order.append(f"{quoted(latest)} desc nulls last")
    return keep_first(df, keys, *order)


def dedupe_max(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Row with the largest ``by``, nulls last."""
    return keep_first(df, keys, f"{quoted(by)} desc nulls last")
