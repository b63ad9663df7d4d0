"""Global ranks, top-N lists and pages."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pavilion.config import RANKING_LIMIT
from pavilion.session import materialize, new_folder

_POSITION = "__position"
_SLICE = "__slice"
_BEFORE = "__before"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def sorted_slices(df: DataFrame, *order: Column, folder: str | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their slice and place in it.

    The slices are written once, because two evaluations could draw different
    range bounds; ``folder`` puts them where the caller can discard them.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    position = F.col(_POSITION)
    return materialize(ranged, "rank", folder).withColumns(
        {
            _SLICE: F.shiftright(position, _ROW_BITS),
            _POSITION: position.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )


def global_rank(df: DataFrame, *order: Column, name: str = "rank", folder: str | None = None) -> DataFrame:
    """Exact 1-based row number over the whole frame, without a one-task window.

    ``order`` must tell all rows apart (end it with a unique key, so that equal
    scores spread over slices too). Each row's rank is its place in its slice plus
    the row counts of the slices before, one number per slice.
    """
    stored = sorted_slices(df, *order, folder=folder)
    sizes = stored.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("__n"))
    # One row per slice: the window and the broadcast are bounded by the partition count.
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_SLICE, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(_BEFORE))
    return (
        stored.join(F.broadcast(offsets), _SLICE)
        .select((F.col(_BEFORE) + F.col(_POSITION) + 1).alias(name), *df.columns)
    )


def top_ranked(
    df: DataFrame, *order: Column, limit: int = RANKING_LIMIT, name: str = "rank"
) -> DataFrame:
    """First ``limit`` rows in order, ranked; the window sees only those rows."""
    if limit < 1:
        raise ValueError("limit must be positive")
    top = df.orderBy(*order).limit(limit)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias(name), *df.columns
    )


def newest(df: DataFrame, by: str, limit: int) -> DataFrame:
    """The ``limit`` largest values of ``by``, in descending order."""
    return df.orderBy(F.col(by).desc()).limit(limit)


def write_ranked(df: DataFrame, order: Sequence[Column], path: str) -> None:
    """Write ``df`` in ``order`` to ``path/rows`` with a rank directory beside it, in ``path/directory``.

    ``order`` must tell all rows apart. The directory has a row per written slice: its file, its number of rows, the rows
    before it and its first row. Pages are then found without sorting or counting; see ``ranked_page``.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn(_POSITION, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), _POSITION)
    slices = stored.groupBy(F.shiftright(_POSITION, _ROW_BITS).alias("slice"), F.col("_metadata.file_path").alias("file")).agg(
        F.min(_POSITION).alias("position"), F.count(F.lit(1)).alias("n_rows"), first.alias("first_row")
    )
    # One row per slice: the window is bounded by the partition count.
    earlier = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    slices.withColumn("n_before", F.coalesce(F.sum("n_rows").over(earlier), F.lit(0))).write.parquet(f"{path}/directory")


def ranked_page(spark: SparkSession, path: str, limit: int, offset: int, name: str = "rank") -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of what ``write_ranked`` wrote, with their rank and the ``total`` of rows.

    Reads the directory, of which only the page's slices reach the driver, and the files of these slices.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    directory = spark.read.parquet(f"{path}/directory")
    total = directory.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()["n"]
    here = (F.col("n_before") < offset + limit) & (F.col("n_before") + F.col("n_rows") > offset)
    slices = directory.where(here).select("file", "position", "n_before", "n_rows").collect()
    schema = spark.read.parquet(f"{path}/rows").schema
    files = sorted({s["file"] for s in slices})
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    place, rank, wanted = F.col(_POSITION), F.lit(None).cast("bigint"), F.lit(False)
    for s in slices:
        # A slice's rows are numbered on; which of them the page takes is known, so files are skipped inside too.
        low = s["position"] + max(0, offset - s["n_before"])
        high = s["position"] + min(s["n_rows"], offset + limit - s["n_before"])
        inside = (place >= low) & (place < high)
        wanted = wanted | inside
        rank = F.when(inside, place - s["position"] + s["n_before"] + 1).otherwise(rank)
    columns = [c for c in schema.names if c != _POSITION]
    return rows.where(wanted).select(rank.alias(name), *columns, F.lit(total).cast("bigint").alias("total"))


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int, folder: str | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in order, each with the frame's row count.

    Sorts and writes the frame for this one page; a table that is read page by page is written
    once by ``write_ranked``.
    """
    if limit < 1 or offset < 0:
        raise ValueError("limit must be positive and offset not negative")
    path = f"{folder or new_folder(df.sparkSession, 'page')}/ranked-{uuid.uuid4().hex}"
    write_ranked(df, order, path)
    return ranked_page(df.sparkSession, path, limit, offset, "__rank").drop("__rank")


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence[Any], limit: int) -> DataFrame:
    """The ``limit`` rows that follow the row with the key values ``last``, in ascending order of ``keys``.

    For walking through pages without counting: rows up to ``last`` are filtered out by key. Null
    keys come last, and ``last`` may hold None.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    follows = F.lit(False)
    for name, value in reversed(list(zip(keys, last, strict=True))):
        column = F.col(name)
        beyond = F.lit(False) if value is None else (column > F.lit(value)) | column.isNull()
        follows = beyond | (column.eqNullSafe(F.lit(value)) & follows)
    return df.where(follows).orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(limit)
