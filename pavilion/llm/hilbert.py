"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is cut at its own quantiles into ``2**bits`` cells. Rows are sorted by their
cell's place on the curve and the sorted sequence is cut into runs of equal counts, so a shard
covers a compact region in all dimensions and readers can skip files on any of them.
"""

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pavilion.operators.rank import global_rank
from pavilion.session import discard, materialize, new_folder


def hilbert_index(axes: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits per axis."""
    x = [np.asarray(a, np.int64).copy() for a in axes]
    # From the highest bit down, turn and mirror the cube so that its pieces join up.
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(x)):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def text_code(column: Column) -> Column:
    """The first seven bytes of a text as a number in the same order; null stays null."""
    return F.conv(F.rpad(F.substring(F.hex(column.cast("binary")), 1, 14), 14, "0"), 16, 10).cast("bigint")


def _place(bits: int):
    def place(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([a.to_numpy() for a in axes], bits))

    return F.pandas_udf(place, "bigint")


def hilbert_shards(
    rows: DataFrame, axes: Mapping[str, Column], n_shards: int, ties: Sequence[Column] = (), bits: int = 4
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``n_shards - 1``) and ``slot`` (gapless from 0 in each shard).

    ``axes`` names the dimensions, numbers or texts; a text counts as its rank among the distinct values, in
    code-point order, and a null takes the lowest cell. Rows of one cell are
    ordered by ``ties``, which should end in a unique key; rows that are equal in all of them are
    taken in any order. Row counts of shards differ by one at most; with fewer rows than shards some shards
    are empty, and an empty table gives an empty table. Columns named shard and slot are replaced.
    """
    if not 1 <= bits * len(axes) <= 62:
        raise ValueError("the curve needs 1 to 62 bits in all")
    spark = rows.sparkSession
    folder = new_folder(spark, "hilbert")
    names = [f"__axis_{i}" for i in range(len(axes))]
    stored = rows.drop("shard", "slot").withColumns(dict(zip(names, axes.values(), strict=True)))
    texts = [n for n in names if isinstance(stored.schema[n].dataType, T.StringType)]
    stored = materialize(stored.withColumns({n: F.col(n).cast("bigint") for n in names if n not in texts}), "rows", folder)
    for name in texts:
        stored = _by_rank(stored, name, folder)
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    found = stored.agg(F.count(F.lit(1)), *[F.percentile_approx(n, shares, 10_000) for n in names]).first()
    total = found[0]

    def cell(name: str, cuts: Sequence[int] | None) -> Column:
        levels = [F.when(F.col(name) > cut, 1).otherwise(0) for cut in cuts or []]
        return sum(levels, F.lit(0)).cast("bigint")

    at = _place(bits)(*[cell(n, cuts) for n, cuts in zip(names, found[1:], strict=True)])
    placed = stored.withColumn("__curve", at)
    ranked = global_rank(placed, F.col("__curve"), *ties, name="__rank").withColumn("__rank", F.col("__rank") - 1)
    discard(spark, folder)  # the ranked rows are written
    return equal_runs(ranked, total, n_shards).drop("__rank", "__curve", *names)


def _by_rank(rows: DataFrame, name: str, folder: str) -> DataFrame:
    """``rows`` with the text ``name`` replaced by its rank among the distinct texts; null stays null."""
    values = rows.where(F.col(name).isNotNull()).select(F.col(name).alias("__value")).distinct()
    ranks = global_rank(values, F.col("__value"), name="__code", folder=folder)
    return rows.join(ranks, F.col(name) == F.col("__value"), "left").withColumn(name, F.col("__code")).drop("__value", "__code")


def equal_runs(ranked: DataFrame, total: int, n_shards: int) -> DataFrame:
    """``ranked`` with the ``shard`` and ``slot`` of each ``__rank`` (from 0, of ``total``)."""
    shard = F.expr(f"(__rank * {n_shards}L) div {max(total, 1)}L")
    # In 64 bits throughout: shard is an int, and its product with the total passes 2**31 early.
    first = F.expr(f"(cast(shard as bigint) * {total}L + {n_shards - 1}L) div {n_shards}L")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("__rank") - first).cast("bigint"))


def shard_documents(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in shards by source, language and size, with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Size is the text's UTF-8 bytes (none for a null) plus 8. Equal texts of a cell are neighbours.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.withColumns({"size": (F.octet_length(text) + 8).cast("bigint"), "text_crc32": F.crc32(text)})
    present = {c: F.col(c).cast("string") if c in docs.columns else F.lit(0) for c in ("source", "lang")}
    return hilbert_shards(sized, present | {"size": F.col("size")}, n_shards, [F.col("text_crc32"), F.col(id_col)])
