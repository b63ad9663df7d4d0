"""Types of text columns, inferred from every cell.

A cell fits one or more types. Types that all cells of a column fit are found by a bitwise and, so a
column's set is merged over tasks like a minimum, in one aggregate over one scan, and a single odd cell
in the last row counts as much as the first ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pavilion.functions.numbers import safe_double
from pavilion.operators.columns import drop_index_columns, quoted

# The lattice from the narrowest type to the widest; a column takes the first that all of its cells fit.
# Every long is a double, and every cell is a text.
LATTICE: tuple[tuple[str, T.DataType], ...] = (
    ("boolean", T.BooleanType()),
    ("bigint", T.LongType()),
    ("double", T.DoubleType()),
    ("date", T.DateType()),
    ("timestamp", T.TimestampType()),
    ("string", T.StringType()),
)
_ALL = (1 << len(LATTICE)) - 1

# Cells that stand for a missing value.
NULLS = ("", "#N/A", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
# Fixed patterns: dates and times in ISO form.
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def present(cell: Column) -> Column:
    """The cell without surrounding blanks, null where it stands for a missing value."""
    text = F.btrim(cell)
    return F.when(~text.isin(*NULLS), text)


def parsed(cell: Column, dtype: T.DataType) -> Column:
    """The cell as a type of the lattice, null where it does not fit; a text keeps its blanks."""
    text = present(cell)
    if isinstance(dtype, T.StringType):
        return F.when(text.isNotNull(), cell)
    if isinstance(dtype, T.BooleanType):
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    if isinstance(dtype, T.LongType):
        return F.when(text.rlike(r"^[+-]?\d{1,19}$"), text).try_cast("bigint")
    if isinstance(dtype, T.DoubleType):
        return safe_double(text)
    if isinstance(dtype, T.DateType):
        return F.when(text.rlike(_DATE), text).try_cast("date")
    if isinstance(dtype, T.TimestampType):
        return F.when(text.rlike(_DATE) | text.rlike(_TIME), text).try_cast("timestamp")
    raise ValueError(f"{dtype.simpleString()} is not in the lattice")


def fitting(cell: Column) -> Column:
    """The set of types that the cell fits, a bit for each; a missing cell fits all."""
    bits = [F.when(parsed(cell, dtype).isNotNull(), 1 << i).otherwise(0) for i, (_, dtype) in enumerate(LATTICE[:-1])]
    own = sum(bits, F.lit(1 << (len(LATTICE) - 1)))
    return F.when(present(cell).isNull(), _ALL).otherwise(own)


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_values) for every text column, from one aggregate over all rows.

    A column without a value is text, and so is one whose cells have no narrower type in common.
    """
    measures = []
    for i, c in enumerate(df.columns):
        cell = F.col(quoted(c))
        measures += [F.bit_and(fitting(cell)).alias(f"fits{i}"), F.count(present(cell)).alias(f"n{i}")]

    def name(i: int) -> Column:
        fits = F.when(F.col(f"n{i}") > 0, F.col(f"fits{i}")).otherwise(0)
        found = F.lit("string")
        for bit, (kind, _) in reversed(list(enumerate(LATTICE[:-1]))):
            found = F.when(fits.bitwiseAND(F.lit(1 << bit)) != 0, kind).otherwise(found)
        return found

    rows = [
        F.struct(F.lit(c).alias("column_name"), name(i).alias("data_type"), F.col(f"n{i}").alias("n_values"))
        for i, c in enumerate(df.columns)
    ]
    if not rows:
        raise ValueError("the frame has no columns")
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def infer_types(df: DataFrame) -> T.StructType:
    """The schema that all cells of the text columns fit; one job, of which one row per column reaches the driver."""
    kinds = dict(LATTICE)
    found = {r["column_name"]: kinds[r["data_type"]] for r in column_types(df).collect()}
    return T.StructType([T.StructField(c, found[c]) for c in df.columns])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The text columns as the types of ``schema``; cells that stand for a missing value, or do not fit, are null."""
    return df.select(*[parsed(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in schema.fields])


def scan_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with equal headers, without index columns, their types inferred from all rows.

    The files are read twice, once for the types. A missing path raises when the frame is defined.
    """
    cells = drop_index_columns(spark.read.options(header=True, enforceSchema=False).csv(path))
    return typed(cells, infer_types(cells))
