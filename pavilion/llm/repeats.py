"""Windows of words or bytes that occur more than once in a corpus, found by seeds.

A window of W units has a seed: its least key among its runs of k units. Equal windows have
equal seeds, and neighbouring windows mostly share theirs, so seeds are few. A long seed is seldom
in unequal windows by chance; it tells which windows may repeat. A short one tells where windows
meet. The steps:

1. keys of all long seeds that repeat, as a filter of bounded size (``keyfilter``);
2. windows whose long seed may repeat, joined into pieces that are cut at some seeds, so that copies
   of a passage are cut alike; equal pieces become one class with a count and a least document;
3. inside the classes, windows whose still longer seed several classes share (one more filter), as small parts
   that are gathered by short seed into blocks;
4. an index of each block finds, for every window of a part, how often it occurs and in which
   least document. The index is the operator's own (``rlz``, ``rindex``).

What a copy costs after step 2 is one short row, and a passage that a third of all documents
share is one class. Texts are read once for the classes and once more for the places of their pieces, so that
contents are not stored beside their own shuffle. Nothing is gathered by a key whose rows are unbounded: blocks hold distinct
texts of windows that repeat, and a seed with too many of them is split into single windows, which
are spread by their own keys. Filters only drop windows that surely occur once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pavilion.llm import textkeys as tk
from pavilion.llm.keyfilter import may_repeat, repeated_keys
from pavilion.session import discard, materialize, release_shuffles

_U = np.uint64
# Filters that large corpora would fill grow to ``2**_GROWTH`` times their size.
_GROWTH = 2


@dataclass(frozen=True)
class Shape:
    """A window of ``window`` units with seeds of ``seed`` units; units are words or bytes.

    ``within`` tells whether a window that repeats inside one document counts as repeated.
    """

    window: int
    seed: int
    words: bool
    within: bool

    @property
    def long_seed(self) -> int:
        """Units of the seeds of texts that go into the filter: half way from seed to window, one for ten of op4's windows."""
        return (self.window + self.seed) // 2

    @property
    def class_seed(self) -> int:
        """The same for classes, which are fewer: half way again, so that fewer windows beside repeated ones share one."""
        return (self.window + self.long_seed) // 2

    def units(self, keyer: tk.Keyer, part: tk.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the units of some texts, and the texts' bounds."""
        if self.words:
            found = keyer.words(part)
            return found.key, found.bounds
        return tk.byte_keys(part), part.offsets

    def content(self, part: tk.Slice) -> tuple[np.ndarray, np.ndarray]:
        """The same for stored pieces: word keys, or the bytes themselves."""
        if self.words:
            return np.frombuffer(part.data.tobytes(), np.uint64), part.offsets // 8
        return tk.byte_keys(part), part.offsets

    def runs(self, keyer: tk.Keyer, values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one seed of ``size`` units: first window, last one plus 1, seed, and, where repeats
        inside a document count, whether the seed lies in the run twice, so that windows may repeat in it."""
        w = self.window - size + 1
        x = keyer.rolling(values, size)
        least = tk.window_min(x, w)
        n = len(least)
        ok = tk.inside_one(bounds, self.window, n)
        if not n:
            none = np.empty(0, np.int64)
            return none, none, np.empty(0, np.uint64), np.empty(0, bool)
        begin, end = ok.copy(), ok.copy()
        change = least[1:] != least[:-1]
        begin[1:] &= ~ok[:-1] | change
        end[:-1] &= ~ok[1:] | change
        first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
        value = least[first]
        if not self.within:
            return first, last, tk.mix(value), np.zeros(len(first), bool)
        at = np.zeros(len(first), np.int64)
        for o in range(w - 1, -1, -1):
            at[x[first + o] == value] = o
        return first, last, tk.mix(value), last - 1 > first + at


def _text_seeds(shape: Shape):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(0)):
                _, _, seed, twice = shape.runs(keyer, *shape.units(keyer, part), shape.long_seed)
                yield np.concatenate([seed, seed[twice]])

    return seeds


def _class_seeds(shape: Shape):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(0)):
                _, _, seed, twice = shape.runs(keyer, *shape.content(part), shape.class_seed)
                yield np.concatenate([seed, seed[twice]])

    return seeds


def _chosen(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Numbers of all windows in the runs."""
    size = last - first
    return np.repeat(last - np.cumsum(size), size) + np.arange(int(size.sum()))


def _blobs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges of ``data`` as a binary column."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[take]))])


def _piece_finder(shape: Shape, seeds, with_content: bool):
    """Pieces of texts: either id, class and content, or row, id, start, n and class."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(2)):
                values, bounds = shape.units(keyer, part)
                first, last, seed, _ = shape.runs(keyer, values, bounds, shape.long_seed)
                keep = may_repeat(seeds.value, seed)
                first, last, seed = first[keep], last[keep], seed[keep]
                if not len(first):
                    continue
                # A piece ends where the runs do, and before every sixteenth seed.
                new = np.concatenate([[True], (last[:-1] != first[1:]) | (seed[1:] & _U(15) == 0)])
                heads = np.flatnonzero(new)
                start, end = first[heads], last[np.concatenate([heads[1:], [len(first)]]) - 1]
                text = np.searchsorted(bounds, start, "right") - 1
                upto = end + shape.window - 1
                rows = pa.array(text + part.first)
                row, ids = (batch.column(i).take(rows) for i in (0, 1))
                key = pa.array(keyer.runs(values, start, upto).view(np.int64))
                if with_content:
                    raw, unit = (values.view(np.uint8), 8) if shape.words else (part.data, 1)
                    yield pa.RecordBatch.from_arrays([ids, key, _blobs(raw, start * unit, upto * unit)], ["id", "class", "content"])
                else:
                    places = pa.array(start - bounds[text], pa.int64()), pa.array(end - start, pa.int64())
                    yield pa.RecordBatch.from_arrays([row, ids, *places, key], ["row", "id", "start", "n", "class"])

    return find


def _part_finder(shape: Shape, shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        for batch in batches:
            for part in tk.slices(batch.column(1)):
                values, bounds = shape.content(part)
                first, last, seed, _ = shape.runs(keyer, values, bounds, shape.class_seed)
                keep = may_repeat(shared.value, seed)
                at = _chosen(first[keep], last[keep])
                if not len(at):
                    continue
                first, _, seed, _ = shape.runs(keyer, values, bounds, shape.seed)
                run = np.searchsorted(first, at, "right") - 1
                new = np.concatenate([[True], (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)])
                heads = np.flatnonzero(new)
                start, end = at[heads], at[np.concatenate([heads[1:], [len(at)]]) - 1] + 1
                text = np.searchsorted(bounds, start, "right") - 1
                upto = end + shape.window - 1
                raw, unit = (values.view(np.uint8), 8) if shape.words else (part.data, 1)
                rows = pa.array(text + part.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(rows) for i in (0, 2, 3)),
                        pa.array(start - bounds[text], pa.int64()),
                        pa.array(seed[run[heads]].view(np.int64)),
                        pa.array(keyer.runs(values, start, upto).view(np.int64)),
                        _blobs(raw, start * unit, upto * unit),
                    ],
                    ["class", "n", "lo", "offset", "seed", "part", "content"],
                )

    return find


#: What an index returns for each part: least document and count of its windows, see ``ranges``.
Index = Callable[[pa.Table], pa.Table]
_RANGE = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("lo", pa.int64()), ("n", pa.int64())])


def ranges(parts: pa.ChunkedArray, lists: np.ndarray, los: np.ndarray, counts: np.ndarray) -> pa.Table:
    """An index's answer: runs of windows ``a`` to ``b - 1`` of a part with one least document and count.

    Part ``i`` has the windows ``lists[i]`` to ``lists[i + 1] - 1``.
    """
    new = np.ones(len(los), bool)
    new[1:] = (los[1:] != los[:-1]) | (counts[1:] != counts[:-1])
    new[lists[:-1][np.diff(lists) > 0]] = True
    at = np.flatnonzero(new)
    end = np.concatenate([at[1:], [len(los)]]) if len(at) else at
    part = np.searchsorted(lists, at, "right") - 1
    fields = [pa.array((at - lists[part]).astype(np.int32)), pa.array((end - lists[part]).astype(np.int32)), pa.array(los[at]), pa.array(counts[at])]
    offsets = pa.array(np.searchsorted(at, lists).astype(np.int32))
    return pa.table({"part": parts.combine_chunks(), "ranges": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(_RANGE)))})


def window_runs(spans: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each row of a list of (a, b) runs of windows: first windows, and last ones plus 1."""
    offsets = spans.offsets.to_numpy()
    first, last = (spans.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield first[a:b], last[a:b]


def joined_runs(start: np.ndarray, stop: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of some ranges, as starts and stops of its maximal runs."""
    order = np.argsort(start)
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    return start[new].tolist(), stop[np.concatenate([new[1:], [True]])].tolist()


def _single_windows(shape: Shape):
    """Every window of a part as a part of its own, under its own key."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyer = tk.Keyer()
        unit = 8 if shape.words else 1
        for batch in batches:
            for part in tk.slices(batch.column(4)):
                values, bounds = shape.content(part)
                keys = keyer.rolling(values, shape.window)
                at = np.flatnonzero(tk.inside_one(bounds, shape.window, len(keys)))
                text = np.searchsorted(bounds, at, "right") - 1
                rows = pa.array(text + part.first)
                key = pa.array(keys[at].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(rows) for i in range(3)),
                        pa.array(batch.column(3).to_numpy()[text + part.first] + at - bounds[text]),
                        key,
                        key,
                        _blobs(part.data, at * unit, (at + shape.window) * unit),
                    ],
                    ["class", "n", "lo", "offset", "seed", "part", "content"],
                )

    return split


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Whether rows of two frames are one row: its key and its id, so that keys only part texts of one id."""
    return (a["row"] == b["row"]) & a["id"].eqNullSafe(b["id"])


_PART = "class bigint, n bigint, lo bigint, offset bigint, seed bigint, part bigint, content binary"


def repeated_windows(docs: DataFrame, shape: Shape, index: Index, folder: str, filter_bits: int, seed_rows: int) -> DataFrame:
    """Pieces of ``docs`` (row, id, text) with windows that may repeat: row, id, start, n, copies, lo, parts.

    ``start`` and ``n`` number the piece's windows in its text, ``copies`` and ``lo`` are the
    count and least id of its class, and ``parts`` (null where there are none) lists the windows
    that classes share: runs of windows ``a`` to ``b - 1`` of the piece, their least id and count.
    """
    spark = docs.sparkSession
    docs = docs.select("row", "id", "text")
    seeds = repeated_keys(docs.select("text"), _text_seeds(shape), filter_bits, _GROWTH)
    release_shuffles(spark)
    classes = docs.mapInArrow(_piece_finder(shape, seeds, True), "id bigint, class bigint, content binary")
    classes = classes.groupBy("class", "content").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("lo"))
    # Tables with contents are deleted as soon as what follows needs only their keys.
    classes = materialize(classes, "classes", f"{folder}/classes")
    release_shuffles(spark)
    pieces = docs.mapInArrow(_piece_finder(shape, seeds, False), "row bigint, id bigint, start bigint, n bigint, class bigint")
    pieces = materialize(pieces, "places", folder)
    described = materialize(classes.drop("content"), "described", folder)
    shared = repeated_keys(classes.select("content"), _class_seeds(shape), filter_bits, _GROWTH)
    release_shuffles(spark)
    parts = materialize(classes.select("class", "content", "copies", "lo").mapInArrow(_part_finder(shape, shared), _PART), "parts", f"{folder}/parts")
    discard(spark, f"{folder}/classes")
    release_shuffles(spark)
    hot = parts.groupBy("seed").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > seed_rows).select("seed")
    hot = materialize(hot, "hot", folder)
    if not hot.isEmpty():
        # Parts of a very common seed are spread: each of their windows goes where its own key belongs.
        common = parts.join(hot, "seed", "left_semi").select("class", "n", "lo", "offset", "content")
        spread = common.mapInArrow(_single_windows(shape), _PART)
        parts = materialize(parts.join(hot, "seed", "left_anti").select(*spread.columns).unionByName(spread), "spread", f"{folder}/parts")
    texts = parts.groupBy("seed", "part", "content").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"))
    texts = materialize(texts, "texts", f"{folder}/texts")
    parts = materialize(parts.select("class", "offset", "part"), "offsets", folder)
    discard(spark, f"{folder}/parts")
    release_shuffles(spark)
    # Blocks of about a megabyte; a seed's parts, at most ``seed_rows`` of them, share a block.
    size = texts.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    blocks = max(int(size) >> 20, 16)
    indexed = (
        texts.withColumn("block", F.pmod(F.xxhash64("seed"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(index, "part bigint, ranges array<struct<a:int,b:int,lo:bigint,n:bigint>>")
    )
    moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("offset")).alias("a"), (r["b"] + F.col("offset")).alias("b"), r["lo"], r["n"]))
    indexed = materialize(indexed, "indexed", folder)
    discard(spark, f"{folder}/texts")
    release_shuffles(spark)
    found = (
        parts.join(indexed, "part")
        .groupBy("class")
        .agg(F.flatten(F.collect_list(moved)).alias("parts"))
    )
    described = described.join(found, "class", "left").where("copies > 1 or parts is not null")
    return pieces.join(described, "class").drop("class")
