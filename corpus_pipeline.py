"""A corpus pipeline: quality rules, near duplicates, benchmark leaks, source mixture, shards.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of documents; documents that a stage rejects are gone for the next one. Columns beyond those
of ``documents`` pass through; a stage's own columns replace columns of the same name in the last
stage only. Rows without a doc_id are kept by the duplicate stage and judged like others elsewhere.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pavilion.llm.cascade import quality_cascade
from pavilion.llm.decontaminate import benchmark_hits
from pavilion.llm.hilbert import hilbert_shards
from pavilion.llm.mixture import mixed_documents
from pavilion.llm.neardup import near_duplicates
from pavilion.session import discard, materialize, new_folder, release_shuffles

SHARDS = 24
# Columns that name a row of a written table: a hash of its file, and its place there.
ROW = ["__file", "__index"]


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ROW``, by which narrow results find their texts again; a frame that reads no files is written first."""
    place = {"__file": F.xxhash64("_metadata.file_path"), "__index": F.col("_metadata.row_index")}
    try:
        return docs.withColumns(place)
    except AnalysisException:
        return materialize(docs, "rows").withColumns(place)


def row_key(docs: DataFrame) -> Column:
    """The operators' key of a document's id and text."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_cascade(docs, kept_col="__kept").where("__kept").drop("__kept")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 percent of their five-word shingles.

    Of rows that repeat a kept id and text one stays.
    """
    found = near_duplicates(docs, shingle_words=5)
    # The rows that go are fewer than those that stay, and written, so Spark knows their size before it joins.
    gone = materialize(found.where("not kept").select(F.col("row").alias("__gone")).distinct(), "duplicates")
    repeated = found.where("kept").groupBy(F.col("row").alias("__row")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    if repeated.isEmpty():
        return docs.join(gone, row_key(docs) == gone["__gone"], "left_anti")
    rows = numbered(docs)
    left = rows.join(gone, row_key(rows) == gone["__gone"], "left_anti")
    places = left.select(row_key(left).alias("__row"), *ROW).join(repeated.select("__row"), "__row")
    first = places.groupBy("__row").agg(F.min(F.struct(*ROW)).alias("__first"))
    more = materialize(places.join(first, "__row").where(F.struct(*ROW) != F.col("__first")).select(*ROW), "repeats")
    return left.join(more, ROW, "left_anti").drop(*ROW)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = materialize(hits.where("contaminated").select(F.col("row").alias("__row")).distinct(), "leaks")
    return docs.join(leaks, row_key(docs) == leaks["__row"], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the source mixture takes: a row per document and pass."""
    return mixed_documents(numbered(docs), row_cols=ROW)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot along the Hilbert curve."""
    rows = numbered(docs.drop("size", "text_crc32", "shard", "slot"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # Sorted and cut without the texts, which meet their places once, when the result is written.
    narrow = rows.select(*ROW, "doc_id", "source", "lang", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    axes = {"source": F.col("source").cast("string"), "lang": F.col("lang").cast("string"), "size": F.col("size")}
    placed = hilbert_shards(narrow, axes, SHARDS, [F.col("text_crc32"), F.col("doc_id")])
    return rows.join(placed.select(*ROW, "size", "text_crc32", "shard", "slot"), ROW).drop(*ROW)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixture", mix),
    ("sharding", shard),
]

# Components of near duplicates and the pseudorandom mixture are not expressible in one SQL query.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, "pipeline")
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), folder)
        if before is not None:
            discard(spark, before)  # what the stage has read
        before = folder
        release_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
