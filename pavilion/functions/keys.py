"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: stands for null inside a surrogate key, so null and '' differ.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def content_key(teams: Column, dates: Column) -> Column:
    """SHA-256 of first team, second team and first date joined by ``_``; nulls are skipped."""
    parts = [F.get(teams, F.lit(0)), F.get(teams, F.lit(1)), F.get(dates, F.lit(0))]
    return F.sha2(F.concat_ws("_", *parts), 256)


def surrogate_key(*columns: Column) -> Column:
    """MD5 of the columns' texts joined by ``-``; never null. Pass doubles as ``reading_text``."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def reading_text(reading: Column) -> Column:
    """A double as text with six decimals, so that equal readings have one text: -0.0 is 0.0."""
    return (reading + F.lit(0.0)).try_cast("decimal(18,6)").cast("string")
