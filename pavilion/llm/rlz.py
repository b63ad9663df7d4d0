"""Duplicate substrings by relative Lempel-Ziv parsing against reference blocks.

The reference is the corpus itself, cut into blocks by seed (``repeats``): a document can share a
window only with a block that holds the window's seed, so parsing against each seed's own block is
the same as parsing against every block. A block is indexed by the suffix order of its words and the
lengths that neighbours in it share. Each passage is parsed from left to right: a factor is the
longest run of words that starts anywhere else in the block too, and the next one begins where it
ends. A factor of a window's length or more is a duplicate span; windows that a factor's end cuts are
looked up at their own first word, so no boundary hides a window. Words are compared one by one, as 64-bit keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.repeats import Shape, joined_runs, ranges, repeated_windows, same_row, window_runs
from pavilion.session import discard, materialize, new_folder, release_shuffles


def suffix_levels(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of symbols, and the ranks of all suffixes by their first 1, 2, 4, .. symbols.

    Every text must end with a symbol of its own, so that suffixes differ before they leave their text.
    """
    n, width = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    levels = [rank]
    while True:
        after = np.zeros(n, np.int64)  # past the end of everything, where suffixes differ already
        after[: max(n - width, 0)] = rank[width:]
        both = (rank.astype(np.int64) << 32) | after
        order = np.argsort(both, kind="stable")
        both = both[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.concatenate([[0], both[1:] != both[:-1]]))
        if not n or rank[order[-1]] == n - 1:
            return order, levels
        levels.append(rank)
        width *= 2


def longest_elsewhere(symbols: np.ndarray) -> np.ndarray:
    """For each place the most symbols from there on that also start at another place."""
    order, levels = suffix_levels(symbols)
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    # From the longest powers of two down; what is shared ends before a text's end.
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        shared += (rank[a + shared] == rank[b + shared]).astype(np.int64) << level
    longest = np.zeros(len(symbols), np.int64)
    longest[order[:-1]] = shared
    longest[order[1:]] = np.maximum(longest[order[1:]], shared)
    return longest


def greedy_factors(longest: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors of the texts ``start[i]:end[i]``, parsed side by side: their starts and lengths.

    A word that matches nowhere is a factor of its own, of length 0.
    """
    places, sizes = [], []
    at = start[start < end]
    end = end[start < end]
    while len(at):
        size = longest[at]
        places.append(at)
        sizes.append(size)
        at = at + np.maximum(size, 1)
        live = at < end
        at, end = at[live], end[live]
    none = [np.empty(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(sizes or none)


def duplicate_windows(longest: np.ndarray, place: np.ndarray, size: np.ndarray, window: int) -> np.ndarray:
    """Which places start a window that repeats, read off the factors and checked at their ends."""
    change = np.zeros(len(longest) + 1, np.int64)
    long = size >= window
    np.add.at(change, place[long], 1)
    np.add.at(change, place[long] + size[long] - window + 1, -1)
    found = np.cumsum(change[:-1]) > 0
    # Windows that begin in a factor and pass its end: the last ones of a long factor, all of a short one.
    first = place + np.maximum(size - window + 1, 0)
    count = place + np.maximum(size, 1) - first
    cut = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    found[cut] = longest[cut] >= window
    return found


def parsed_windows(window: int):
    """Index of a block of word keys: which windows of each text start elsewhere too, as a count of 1 or 2."""

    def index(block: pa.Table) -> pa.Table:
        texts = block.column("content").combine_chunks()
        size = np.fromiter((len(x.as_buffer()) for x in texts), np.int64) // 8
        values = np.frombuffer(b"".join(x.as_buffer() for x in texts), np.uint64)
        # Words are numbered after the texts' ends, which are symbols of their own.
        end = np.cumsum(size + 1) - 1
        start = end - size
        symbols = np.empty(len(values) + len(size), np.int64)
        symbols[end] = np.arange(len(size))
        inside = np.ones(len(symbols), bool)
        inside[end] = False
        symbols[inside] = np.unique(values, return_inverse=True)[1] + len(size)
        longest = longest_elsewhere(symbols)
        # A text that the corpus holds several times goes on to its end somewhere else.
        copied = np.repeat(block.column("n").to_numpy() > 1, size + 1)
        left = np.repeat(end, size + 1) - np.arange(len(symbols))
        longest = np.where(copied, left, longest)
        found = duplicate_windows(longest, *greedy_factors(longest, start, end), window)
        windows = np.maximum(size - window + 1, 0)
        lists = np.concatenate([[0], np.cumsum(windows)])
        at = np.repeat(start - lists[:-1], windows) + np.arange(lists[-1])
        counts = found[at].astype(np.int64) + 1
        return ranges(block.column("part"), lists, np.zeros(len(at), np.int64), counts)

    return index


def _cutter(window: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": [], "factors": []}
            texts = batch.column(1)
            for i, (first, last) in enumerate(window_runs(batch.column(2))):
                text = texts[i].as_buffer() if texts[i].is_valid else b""
                found, factors = bytes(text).split(), []
                kept = found
                if len(first):
                    starts, stops = joined_runs(first, last + window - 1)
                    kept = [w for a, b in zip([0, *stops], [*starts, len(found)], strict=True) for w in found[a:b]]
                    factors = [{"start": a, "n_words": b - a} for a, b in zip(starts, stops, strict=True)] if with_text else []
                joined = b" ".join(kept)
                out["n_words"].append(len(found))
                out["n_removed"].append(len(found) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["kept_text"].append(joined.decode() if with_text else None)
                out["factors"].append(factors)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["kept_sha256"], pa.string()),
                    pa.array(out["kept_text"], pa.string()),
                    pa.array(out["factors"], pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "factors"],
            )

    return cut


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 35,
    seed_words: int = 8,
    filter_bits: int = 27,
    seed_rows: int = 50_000,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text, factors.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes when a window of ``window``
    words over it occurs a second time anywhere, in another document or the same one; windows
    are judged on the input. ``factors`` lists the removed runs as first word and length.
    ``kept_text`` joins the other words by one space (null, and ``factors`` empty, unless ``with_text``).

    A null or wordless text has no words and keeps the empty text. Rows repeated with id and
    text count as copies of each other, also those without an id. Other columns are not read.
    ``filter_bits`` sets the size of the seed filters, ``2**filter_bits / 8`` bytes each, or up to four
    times that below five bits per repeated seed, where false candidates are near a tenth.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "rlz")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("row", F.xxhash64("id", "text"))
    pieces = repeated_windows(docs, Shape(window, seed_words, words=True, within=True), parsed_windows(window), folder, filter_bits, seed_rows)
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b")))
    held = F.filter("parts", lambda p: p["n"] > 1)
    some = F.transform(held, lambda p: F.struct((F.col("start") + p["a"]).alias("a"), (F.col("start") + p["b"]).alias("b")))
    spans = pieces.select("row", "id", F.when(F.col("copies") > 1, whole).otherwise(some).alias("spans"))
    spans = spans.where("size(spans) > 0").groupBy("row", "id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = materialize(spans, "spans", new_folder(spark, "rlz-spans"))
    discard(spark, folder)
    release_shuffles(spark)
    cut = docs.join(spans, same_row(docs, spans), "left").select(docs["id"], "text", "spans").mapInArrow(
        _cutter(window, with_text),
        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, factors array<struct<start:bigint,n_words:bigint>>",
    )
    return cut
