"""Benchmark decontamination by a prefix-filtered containment join.

Every item is cut into windows, each a set of word shingles with places. A window lies in a
document only if all its shingles do, so one necessary token is enough to look it up: the
shingle that is rarest over the documents. Documents that hold this token give a candidate
start; positions and lengths rule out starts that leave no room, and the window's other
shingles must follow at their places, one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pavilion.llm import textkeys as tk
from pavilion.session import discard, materialize, new_folder

_U = np.uint64


def _item_windows(window: int, shingle: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for part in tk.slices(batch.column(1)):
                found = keyer.words(part, tk.ALNUM, lower=True)
                rows = []
                for i in range(part.n):
                    a, b = found.bounds[i], found.bounds[i + 1]
                    size = min(window, b - a)
                    for at in range(a, b - size + 1) if size else ():
                        keys = keyer.rolling(found.key[at : at + size], min(shingle, size))
                        rows.append((ids[part.first + i], int(size), keys.view(np.int64).tolist()))
                yield pa.RecordBatch.from_pylist(
                    [{"item": i, "words": n, "shingles": s} for i, n, s in rows],
                    pa.schema([("item", pa.string()), ("words", pa.int64()), ("shingles", pa.list_(pa.int64()))]),
                )

    return cut


def _document_shingles(sizes: list[int], bits):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        mask = _U(len(bits.value) * 8 - 1)
        for batch in batches:
            for part in tk.slices(batch.column(1)):
                found = keyer.words(part, tk.ALNUM, lower=True)
                text = found.text
                keys, places, texts = [], [], []
                for k in sizes:
                    key = keyer.rolling(found.key, k)
                    slot = key & mask
                    held = (bits.value[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1
                    at = np.flatnonzero(held & tk.inside_one(found.bounds, k, len(key)))
                    keys.append(key[at])
                    texts.append(text[at])
                    places.append(at - found.bounds[text[at]])
                texts = np.concatenate(texts)
                by = np.argsort(texts, kind="stable")
                lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(texts, minlength=part.n))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.n),
                        batch.column(2).slice(part.first, part.n),
                        pa.array(np.diff(found.bounds), pa.int64()),
                        pa.ListArray.from_arrays(lists, pa.array(np.concatenate(keys)[by].view(np.int64))),
                        pa.ListArray.from_arrays(lists, pa.array(np.concatenate(places)[by], pa.int64())),
                    ],
                    ["id", "row", "n_words", "keys", "places"],
                )

    return find


def _filter_bits(keys: DataFrame, bits: int) -> np.ndarray:
    """Bit filter of fixed size over a column ``key``, built by Spark's own bitmap aggregate."""
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    rows = keys.groupBy(F.floor(slot / F.lit(1 << 15)).cast("bigint").alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.collect():  # the whole filter, whatever the input
        out[row["at"] << 12 : (row["at"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return out


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shingle_words: int = 3,
    filter_bits: int = 23,
) -> DataFrame:
    """One row per document: doc_id, row, n_words, n_hit, n_items, items_sha256, contaminated, items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. An item's windows are
    its runs of ``window`` words, or all its words where it has fewer; a document's word is hit
    where it lies inside an occurrence of a window. ``items`` lists the ids, as sorted
    strings, of the items with occurring windows, and ``items_sha256`` is the hash of their comma-joined list.
    ``row`` is a key of (id, text), by which a caller can find the document again.

    A null or wordless document has no words and no hits, a null or wordless item no windows.
    An item without an id counts under the empty string; items that share an id are one.
    Repeated documents get equal rows. Other columns are not read. The filter of
    ``2**filter_bits`` bits keeps shingles of no item from being stored; a full one costs time only.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "decontaminate")
    cut = items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")), F.col(item_text_col).cast("string"))
    cut = materialize(cut.mapInArrow(_item_windows(window, shingle_words), "item string, words bigint, shingles array<bigint>"), "items", folder)
    wanted = cut.select("words", "shingles").distinct()
    sizes = [r[0] for r in wanted.select(F.least("words", F.lit(shingle_words))).distinct().collect()]
    bits = spark.sparkContext.broadcast(_filter_bits(wanted.select(F.explode("shingles").alias("key")).distinct(), filter_bits))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = docs.select("id", "text", F.xxhash64("id", "text").alias("row"))
    scheme = "id bigint, row bigint, n_words bigint, keys array<bigint>, places array<bigint>"
    if not sizes:
        stored = docs.mapInArrow(_document_shingles([1], bits), scheme)
        hits = None
    else:
        stored = materialize(docs.mapInArrow(_document_shingles(sorted(sizes), bits), scheme), "documents", folder)
        once = stored.where("size(keys) > 0").dropDuplicates(["row"])
        held = once.select("row", "n_words", F.posexplode("keys").alias("i", "key"), "places").select(
            "row", "n_words", "key", F.get("places", F.col("i")).alias("place")
        )
        held = materialize(held, "held", folder)
        counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("count"))
        tokens = wanted.select("words", "shingles", F.posexplode("shingles").alias("offset", "key")).join(counts, "key")
        # The rarest shingle of a window; a window with a shingle that no document holds is left out.
        rarest = tokens.groupBy("words", "shingles").agg(
            F.min(F.struct("count", "key", "offset")).alias("token"), F.count(F.lit(1)).alias("known")
        )
        rarest = rarest.where("known = size(shingles)").select("words", "shingles", "token.key", "token.offset")
        rarest = materialize(rarest, "prefix", folder)
        start = (F.col("place") - F.col("offset")).alias("start")
        candidates = held.join(rarest, "key").select("row", start, "n_words", "words", "shingles")
        candidates = candidates.where("start >= 0 and start + words <= n_words").drop("n_words")
        spread = candidates.select("row", "start", "words", "shingles", F.posexplode("shingles").alias("i", "key")).withColumn("place", F.col("start") + F.col("i"))
        verified = (
            spread.join(held.select("row", "place", "key"), ["row", "place", "key"])
            .groupBy("row", "start", "words", "shingles")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n = size(shingles)")
        )
        hits = materialize(verified.select("row", "start", "words", "shingles"), "hits", folder)
    if hits is None:
        none = F.array().cast("array<string>")
        found = stored.select("id", "row", "n_words", F.lit(0).cast("bigint").alias("n_hit"), none.alias("items"))
    else:
        ends = F.max(F.col("start") + F.col("words")).over(
            Window.partitionBy("row").orderBy("start", "words").rowsBetween(Window.unboundedPreceding, -1)
        )
        covered = hits.select("row", "start", "words").distinct()
        covered = covered.withColumn("before", F.coalesce(ends, F.lit(0)))
        fresh = F.greatest(F.lit(0), F.col("start") + F.col("words") - F.greatest("start", "before"))
        n_hit = covered.groupBy("row").agg(F.sum(fresh).alias("n_hit"))
        names = cut.join(hits.select("shingles", "words", "row").distinct(), ["shingles", "words"])
        names = names.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
        found = stored.join(n_hit.join(names, "row"), "row", "left").select(
            "id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
        )
    result = found.select(
        F.col("id").alias("doc_id"),
        "row",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "items",
    )
    result = materialize(result, "result", new_folder(spark, "decontaminate-result"))
    discard(spark, folder)
    return result
