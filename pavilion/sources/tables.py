"""CSV, JSON and Parquet tables, partitioned by ingestion date."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from pavilion.config import CODECS
from pavilion.functions.text import file_key
from pavilion.operators.columns import complete_schema, computed_once, drop_index_columns

DATE_COLUMN = "ingestion_date"
CORRUPT = "corrupt"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, its columns taken by name; a column the header lacks is null.

    A missing path raises when the frame is defined. Files whose headers differ in order fail the
    read instead of being misread.
    """
    return complete_schema(spark.read.options(header=True, enforceSchema=False).csv(path), schema)


def scan_sample(spark: SparkSession, folder: str, source: str) -> DataFrame:
    """The sample file of a source, all columns text and without index columns.

    The header decides the columns, since sample files come in two spellings.
    """
    frame = spark.read.option("header", True).csv(f"{folder}/{source}_sample.csv")
    return drop_index_columns(frame)


def scan_json_docs(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = True,
    key: str | None = "match_id",
) -> DataFrame:
    """JSON documents, one per file (``multi_line``) or one per line, with an explicit schema.

    ``key`` adds the digits of the file name as a column. ``corrupt`` has the text of a document
    that is no valid JSON; see ``parsed_documents``.
    """
    texts = spark.read.text(path, wholetext=multi_line)
    if key is None:
        return parsed_documents(texts, "value", schema)
    return parsed_documents(texts, "value", schema, file_key(F.col("_metadata.file_path")).alias(key))


def parsed_documents(texts: DataFrame, column: str, schema: T.StructType, *keep: Column) -> DataFrame:
    """``keep``, the fields of the JSON documents in ``column``, and ``corrupt``.

    ``corrupt`` is null for a sound document. A document that is cut off or otherwise no JSON has
    its text there and whatever fields could be read; ``quality.quarantine`` with
    ``sound_document`` splits such rows off.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    doc = computed_once(F.from_json(column, whole, {"columnNameOfCorruptRecord": CORRUPT}))
    parsed = texts.select(*keep, doc.alias("__doc"))
    return parsed.select(*parsed.drop("__doc").columns, "__doc.*")


def table_path(layer_root: str, table: str) -> str:
    """Root of a table whose partitions lie under ``ingestion_date=YYYY-MM-DD``."""
    return f"{layer_root.rstrip('/')}/{table}"


def partition_path(layer_root: str, table: str, date: dt.date | None = None) -> str:
    date = date or dt.datetime.now(dt.UTC).date()
    return f"{table_path(layer_root, table)}/{date_partition(date)}"


def date_partition(date: dt.date) -> str:
    return f"{DATE_COLUMN}={date:%Y-%m-%d}"


def table_writer(df: DataFrame, compression: str = "snappy", dictionary: bool = True, row_group_bytes: int | None = None):
    """A Parquet writer with a codec, dictionaries or none, and a row group size."""
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    options = {"compression": compression, "parquet.enable.dictionary": str(dictionary).lower()}
    if row_group_bytes is not None:
        options["parquet.block.size"] = str(row_group_bytes)
    return df.write.options(**options)


def write_partition(
    df: DataFrame,
    root: str,
    date: dt.date | None = None,
    compression: str = "snappy",
    dictionary: bool = True,
    row_group_bytes: int | None = None,
) -> None:
    """Replace the partition of one ingestion date (default today, UTC); others stay.

    The partition's own folder is overwritten, so an empty frame empties it.
    """
    date = date or dt.datetime.now(dt.UTC).date()
    writer = table_writer(df.drop(DATE_COLUMN), compression, dictionary, row_group_bytes)
    writer.mode("overwrite").parquet(f"{root.rstrip('/')}/{date_partition(date)}")


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All partitions of a table, with ``ingestion_date`` as a date column."""
    if schema is None:
        return spark.read.parquet(root)
    fields = [*schema.fields, T.StructField(DATE_COLUMN, T.DateType())]
    return spark.read.schema(T.StructType(fields)).parquet(root)


def read_partition(
    spark: SparkSession, root: str, date: dt.date, schema: T.StructType | None = None
) -> DataFrame:
    """One ingestion date; the filter prunes the other partitions."""
    return read_table(spark, root, schema).where(F.col(DATE_COLUMN) == F.lit(date))


def read_with_row_id(spark: SparkSession, path: str, name: str = "row_id") -> DataFrame:
    """A Parquet table with a row id; see ``with_row_id``."""
    return with_row_id(spark.read.parquet(path), name)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A frame that reads files, with a row id from file and position, the same on every read.

    Tells identical rows apart, which a hash of the values cannot.
    """
    row = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.select(*df.columns, row.alias(name))


def write_full_refresh(
    df: DataFrame, path: str, given: DataFrame | None = None, compression: str = "snappy"
) -> bool:
    """Replace a table, unless ``given`` is passed and empty. Returns whether it wrote.

    ``given`` is the raw input: testing that reads one row, whereas testing a
    joined result would run its shuffles a second time. The new table is written beside the old one, which is
    there until the new one is complete; ``commits`` replaces several tables in one step.
    """
    if given is not None and given.isEmpty():
        return False
    spark = df.sparkSession
    fresh, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path.rstrip('/')}.{uuid.uuid4().hex}", path))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        table_writer(df, compression).parquet(fresh.toString())
        fs.delete(old, True)
        if not fs.rename(fresh, old):
            raise OSError(f"{fresh.toString()} could not be renamed to {path}")
    except BaseException:
        if fs.exists(old):  # otherwise the new table is all there is
            fs.delete(fresh, True)
        raise
    return True


def land_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write each row as one JSON document on its own line; null fields are kept."""
    text = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    writer = text.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def audited(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame and an observation that counts its rows during whatever job reads it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias(name)), observation
