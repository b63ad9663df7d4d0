"""Duplicate byte substrings by a run-length index.

Each block of repeated passages (``repeats``) is indexed by its run-compressed Burrows-Wheeler
transform: the runs' symbols, first rows and mapped rows, and samples at the run ends: where the suffix
before the mapped row starts (one symbol before the end of the last run with the same symbol), and how
many bytes the two share. The suffix array is built for this and not kept.

All texts of the block are streamed backwards through the index at once, one symbol a step, with
their matching statistics: the length of the match with the suffix in the row before, and where that
one starts. Inside a run both grow by the step's symbol, because the row before has the same symbol in
front; at a run's head they are read from the samples. A window whose match is as long as itself points to an
equal window in this way, and the chains of such pointers, followed to their ends, give the least
document that a window starts in. The index follows the runs; a block's texts and the streamed matches,
sixteen bytes a window, follow its bytes, about a megabyte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.repeats import Shape, joined_runs, ranges, repeated_windows, same_row, window_runs
from pavilion.session import discard, materialize, new_folder, release_shuffles

_U = np.uint64


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of texts of symbols 1.., each ended by a 0; zeros sort by their place."""
    n = len(symbols)
    width = 7
    key, live = np.zeros(n, _U), np.ones(n, bool)
    padded = np.concatenate([symbols.astype(_U), np.zeros(width, _U)])
    for j in range(width):  # symbols after the text's end do not count
        at = padded[j : j + n]
        key = (key << _U(9)) | np.where(live, at, _U(0))
        live &= at > 0
    order = np.argsort(key)
    # Suffixes that end within the key are settled: equal ones sort by place.
    ended = ~live[order]
    short = order[ended]
    order[ended] = short[np.lexsort((short, key[short]))]
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | ended[1:] | ended[:-1]])
    while True:
        # A rank is the place of its group's first row, so finer ranks keep the coarser order.
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        if new.all():
            return order
        # Only rows of groups that are not settled yet are sorted on.
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        at = order[rows]
        after = rank[np.minimum(at + width, n - 1)]
        both = (rank[at].astype(_U) << _U(32)) | after.astype(_U)
        by = np.argsort(both)
        order[rows] = at[by]
        both = both[by]
        new[rows[1:]] |= (both[1:] != both[:-1]) & (rows[1:] == rows[:-1] + 1)
        width *= 2


def shared_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many bytes from ``a`` and ``b`` on are equal, up to ``most``; eight more bytes must follow the last."""
    words = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    size = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        differ = words[a[live] + size[live]] ^ words[b[live] + size[live]]
        lowest = np.maximum(differ & (~differ + _U(1)), _U(1))
        more = np.where(differ == 0, 8, np.log2(lowest).astype(np.int64) // 8)
        size[live] += more
        live = live[(more == 8) & (size[live] < most[live])]
    return np.minimum(size, most)


class RunIndex(NamedTuple):
    """Run-compressed transform: of each run its first row, its symbol and the row that its first row maps to.

    ``above`` and ``shared`` sample the run ends: where the suffix in the row before the mapped one starts, and
    how many bytes the two share.
    """

    head: np.ndarray
    symbol: np.ndarray
    mapped: np.ndarray
    above: np.ndarray
    shared: np.ndarray

    def back(self, row: np.ndarray, length: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the suffix that is longer by one symbol, its match with the row before, and where that one starts."""
        run = np.searchsorted(self.head, row, "right") - 1
        past = row - self.head[run]
        length = np.where(past == 0, self.shared[run], length + 1)
        source = np.where(past == 0, self.above[run], source - 1)
        return self.mapped[run] + past, length, source


def run_index(symbols: np.ndarray, data: np.ndarray) -> RunIndex:
    """Index of texts of symbols 1.., each ended by a 0; ``data`` holds them as bytes, and eight bytes more."""
    order = suffix_order(symbols)
    last = symbols[order - 1]
    head = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
    size = np.diff(np.concatenate([head, [len(last)]]))
    symbol = last[head]
    by = np.argsort(symbol, kind="stable")
    mapped = np.empty(len(head), np.int64)
    mapped[by] = np.concatenate([[0], np.cumsum(size[by])[:-1]])
    # Matches stop at the ends of their texts; the first row has none before it and is an end itself.
    at, above = order[mapped], order[mapped - 1]
    ends = np.flatnonzero(symbols == 0)
    left = np.minimum(ends[np.searchsorted(ends, at)] - at, ends[np.searchsorted(ends, above)] - above)
    return RunIndex(head, symbol, mapped, above, shared_bytes(data, at, above, left))


def matches(index: RunIndex, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Matching statistics of all windows of the indexed texts, of ``size`` bytes each: length of the match and
    the position where it starts, in the texts one after another, each followed by its end."""
    ends = np.cumsum(size + 1) - 1
    lists = np.concatenate([[0], np.cumsum(np.maximum(size - window + 1, 0))])
    lengths, sources = np.zeros(lists[-1], np.int64), np.empty(lists[-1], np.int64)
    # The texts' ends are the first rows, in their order, and share nothing.
    live, row = np.arange(len(size)), np.arange(len(size))
    length, source = np.zeros(len(size), np.int64), np.concatenate([[-1], ends])[: len(size)]
    for step in range(1, int(size.max(initial=0)) + 1):
        if len(live) and (size[live] < step).any():
            going = size[live] >= step
            live, row, length, source = live[going], row[going], length[going], source[going]
        row, length, source = index.back(row, length, source)
        if step >= window:
            at = lists[live] + size[live] - step
            lengths[at], sources[at] = length, source
    return lengths, sources


def least_documents(window: int):
    """Index of a block of texts: for each window of each text its least document."""

    def index(block: pa.Table) -> pa.Table:
        texts = block.column("content").combine_chunks()
        lo = block.column("lo").to_numpy()
        size = np.fromiter((len(x.as_buffer()) for x in texts), np.int64)
        ends = np.cumsum(size + 1) - 1
        data = np.frombuffer(b"\0".join(x.as_buffer() for x in texts) + bytes(9), np.uint8)
        symbols = data[: ends[-1] + 1].astype(np.int16) + 1
        symbols[ends] = 0
        lengths, sources = matches(run_index(symbols, data), size, window)
        windows = np.maximum(size - window + 1, 0)
        lists = np.concatenate([[0], np.cumsum(windows)])
        # Equal windows are neighbouring rows, so their pointers make one chain, which ends at its first row.
        first = np.arange(lists[-1])
        long = np.flatnonzero(lengths >= window)
        text = np.searchsorted(ends, sources[long])
        first[long] = lists[text] + sources[long] - (ends - size)[text]
        while len(long):
            further = first[first[long]]
            moved = further != first[long]
            first[long] = further
            long = long[moved]
        own = np.repeat(lo, windows)
        least = own.copy()
        np.minimum.at(least, first, own)
        return ranges(block.column("part"), lists, least[first], np.zeros(len(first), np.int64))

    return index


def _cutter(window: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column(1)
            for i, (first, last) in enumerate(window_runs(batch.column(2))):
                text = bytes(texts[i].as_buffer()) if texts[i].is_valid else b""
                kept, starts, stops = text, (), ()
                if len(first):
                    starts, stops = joined_runs(first, last + window - 1)
                    gone = memoryview(text)
                    kept = b"".join(gone[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True))
                spans = [{"start": a, "n_bytes": b - a} for a, b in zip(starts, stops, strict=True)] if with_text else []
                rows.append((len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept if with_text else None, spans))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("n_bytes", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "spans"],
            )

    return cut


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    seed_bytes: int = 16,
    filter_bits: int = 28,
    seed_rows: int = 50_000,
    with_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes, spans.

    Texts are UTF-8 bytes. A byte goes when a string of ``window`` bytes over it also starts in a
    document with a smaller id; strings are judged on the input and never cross documents.
    ``spans`` lists the removed runs as first byte and length. ``kept_bytes`` (null, and ``spans`` empty,
    unless ``with_text``) need not be valid UTF-8, because a string may end inside a character.

    A null text is empty. A row without an id is neither smaller nor larger than others: it
    loses nothing and is no source. Rows that repeat an id have no smaller id among them.
    Other columns are not read. ``window`` is 16 at least.
    """
    if window < max(16, seed_bytes):
        raise ValueError("the window must hold its seed and 16 bytes")
    spark = docs.sparkSession
    folder = new_folder(spark, "rindex")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("id", "text"))
    pieces = repeated_windows(docs.where("id is not null"), Shape(window, seed_bytes, words=False, within=False), least_documents(window), folder, filter_bits, seed_rows)
    start = F.col("start")
    whole = F.array(F.struct(start.alias("a"), (start + F.col("n")).alias("b")))
    held = F.filter("parts", lambda p: p["lo"] < F.col("id"))
    some = F.transform(held, lambda p: F.struct((start + p["a"]).alias("a"), (start + p["b"]).alias("b")))
    spans = pieces.where("lo < id or parts is not null").select("row", "id", F.when(F.col("lo") < F.col("id"), whole).otherwise(some).alias("spans"))
    spans = spans.where("size(spans) > 0").groupBy("row", "id").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = materialize(spans, "spans", new_folder(spark, "rindex-spans"))
    discard(spark, folder)
    release_shuffles(spark)
    return docs.join(spans, same_row(docs, spans), "left").select(docs["id"], "text", "spans").mapInArrow(
        _cutter(window, with_text),
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary, spans array<struct<start:bigint,n_bytes:bigint>>",
    )
