"""Joins for skewed keys, null-safe joins and the helpers around them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.config import SALT_BUCKETS

_SALT = "__salt"
_SALTS = "__salts"


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every column name with a prefix, except those in ``keep``."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def replicate(df: DataFrame, copies: int | Column, name: str = "salt") -> DataFrame:
    """``copies`` copies of each row, numbered from 0; grows row by row, without a cross join."""
    count = F.lit(copies) if isinstance(copies, int) else copies
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))


def _row_hash(df: DataFrame, salt_by: Sequence[str] | None) -> Column:
    # A hash of the row, not a random number: a retried task salts the same way.
    return F.xxhash64(*[F.col(c) for c in (salt_by or df.columns)])


# Salts of rows with a null key, which match nothing and may lie anywhere.
_NULL_SALTS = 1 << 20


def _hinted(df: DataFrame, hint: str | None) -> DataFrame:
    return df.hint(hint) if hint else df


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    buckets: int = SALT_BUCKETS,
    salt_by: Sequence[str] | None = None,
    how: str = "left",
    hint: str | None = None,
) -> DataFrame:
    """Join on ``on`` with every key spread over ``buckets`` salts; same rows as the plain join.

    Copies every right row ``buckets`` times, so ``hot_key_join`` is the better choice
    unless most keys are hot. ``hint`` names the strategy of the join (``merge``,
    ``shuffle_hash``); without it Spark chooses.

    ``salt_by`` names the columns that tell left rows apart (default: all). Where
    a table holds many identical rows, pass a row id such as
    ``sources.tables.read_with_row_id`` adds, or all copies get the same salt.
    """
    if how not in ("left", "inner"):
        raise ValueError("only the left side is salted, so the join is left or inner")
    salts = F.when(F.col(on).isNull(), F.lit(_NULL_SALTS)).otherwise(F.lit(buckets))
    salted_left = left.withColumn(_SALT, F.pmod(_row_hash(left, salt_by), salts).cast("int"))
    salted_right = replicate(right, buckets, _SALT)
    return salted_left.join(_hinted(salted_right, hint), [on, _SALT], how).drop(_SALT)


# Key types that Spark's frequent-items sketch takes; others are counted exactly.
_SKETCHED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
# Fixed values of that sketch: its error is 3.5 rows in as many as its table has places, a power of two, of
# which three quarters are used; it takes at most a million keys.
_SKETCH_ERROR, _SKETCH_MOST = 3.5, 1_000_000
_SKETCH_GROUPS = 64  # sketches are combined in two steps, so that no task combines those of all others


def frequent_keys(df: DataFrame, on: str, at_least: int) -> DataFrame | None:
    """Keys of which some have more than ``at_least`` rows, and none that has is missing; None where that would not fit a sketch.

    A sketch per task, combined in two steps; no key is shuffled by itself. A key is reported if it surely has more
    rows than the sketch's error, and the sketch is made large enough for that to be half of
    ``at_least``. So there are at most twice as many keys as tasks of ``at_least`` rows.
    """
    if not isinstance(df.schema[on].dataType, _SKETCHED):
        return None
    places = 2 * _SKETCH_ERROR * df.count() / max(at_least, 1)  # from the files' own counts where the frame is stored
    tracked = max(64, math.ceil(places))
    if tracked > _SKETCH_MOST:
        return None
    keys = df.where(F.col(on).isNotNull()).select(F.col(on).alias("__key"))
    group = F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("__group")
    sketches = keys.groupBy(group).agg(F.expr(f"approx_top_k_accumulate(__key, {tracked})").alias("__sketch"))
    # Grouped, by a constant: without a key, tasks that have no sketch would hand on an empty one, which cannot be combined.
    combined = sketches.groupBy(F.lit(0).alias("__all")).agg(F.expr("approx_top_k_combine(__sketch)").alias("__sketch"))
    found = combined.select(F.explode(F.expr(f"approx_top_k_estimate(__sketch, {tracked})")).alias("__found"))
    return found.select(F.col("__found.item").alias(on))


def hot_keys(df: DataFrame, on: str, rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of salts each needs.

    A sketch names the candidates, and only their rows are counted, exactly. Where a sketch would have to be too large
    all keys are counted, combined before the shuffle. Only the key column is read.
    """
    keys = df.where(F.col(on).isNotNull()).select(on)
    candidates = frequent_keys(df, on, rows_per_task)
    if candidates is not None:
        # Bounded: at most twice as many keys as tasks of rows_per_task rows.
        keys = keys.join(F.broadcast(candidates), on, "left_semi")
    counts = keys.groupBy(on).agg(F.count(F.lit(1)).alias("__rows"))
    salts = F.ceil(F.col("__rows") / F.lit(rows_per_task)).cast("int")
    return counts.where(F.col("__rows") > rows_per_task).select(on, salts.alias(_SALTS))


def hot_key_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    rows_per_task: int = 1_000_000,
    salt_by: Sequence[str] | None = None,
    how: str = "left",
    hint: str | None = None,
) -> DataFrame:
    """Join that salts hot keys only, with as many salts as their row counts ask for.

    Right rows of ordinary keys are not copied. Null keys match nothing, so left
    rows with a null key take any salt and do not pile up in one task. The left side's
    key is read twice more, for a sketch and for the candidates' counts, so pass a stored table. All hot keys are
    salted, however many there are; Spark's own size check decides how their list is
    joined. ``rows_per_task`` sets what is hot, never what is returned. ``hint`` names
    the strategy of the last join.
    """
    if how not in ("left", "inner"):
        raise ValueError("only the left side is salted, so the join is left or inner")
    hot = hot_keys(left, on, rows_per_task)
    row_hash = _row_hash(left, salt_by)
    salt = (
        F.when(F.col(on).isNull(), F.pmod(row_hash, F.lit(_NULL_SALTS)))
        .when(F.col(_SALTS).isNotNull(), F.pmod(row_hash, F.col(_SALTS)))
        .otherwise(F.lit(0))
        .cast("int")
    )
    salted_left = left.join(hot, on, "left").withColumn(_SALT, salt).drop(_SALTS)
    copies = F.coalesce(F.col(_SALTS), F.lit(1))
    salted_right = replicate(right.join(hot, on, "left"), copies, _SALT).drop(_SALTS)
    return salted_left.join(_hinted(salted_right, hint), [on, _SALT], how).drop(_SALT)


def full_outer_null_safe(
    left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: Sequence[str]
) -> DataFrame:
    """Full outer join on ``on`` (null matches nothing) and ``null_safe`` (null matches null).

    Meant for tables with one row per key. Key columns of both sides are merged,
    other columns keep their names, which must not overlap.
    """
    keys = [*on, *null_safe]
    other = prefixed(right.select(*keys, *[c for c in right.columns if c not in keys]), "__r_")
    condition = [F.col(k) == F.col(f"__r_{k}") for k in on]
    condition += [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in null_safe]
    joined = left.join(other, condition, "full_outer")
    merged = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    left_rest = [F.col(c) for c in left.columns if c not in keys]
    right_rest = [F.col(f"__r_{c}").alias(c) for c in right.columns if c not in keys]
    return joined.select(*merged, *left_rest, *right_rest)
