"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked ids by external spill counting.

Both token sequences of a text cover the same bytes; offsets where tokens of both end cut them into groups, and all
pairs of a group are linked. Tasks work on chunks of whole documents. A chunk's pair-document records are sorted by
first id, second id and document, dealt by first id to radix partitions and written as zstd runs: the
pairs with their number of documents, and apart from them the documents. Runs of a partition, some at a time, are merged
by a heap over their heads, block by block; counts add up, and because the order is by first id, the highest
count of an id is known when its pairs end. Counts stream back run by run, and a chunk's documents are
summed from the runs of their chunk. What is shuffled is a record per pair and run, not one per occurrence, so a
pair of every document is one record a run.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pavilion.session import discard, materialize, new_folder

#: Characters and documents after which a chunk is full; a longer text makes a chunk of its own.
CHUNK_CHARS, CHUNK_DOCS = 1 << 21, 1 << 15
#: Characters encoded at once, and those of the words whose ids a task keeps.
_PACK_CHARS, _KNOWN_CHARS = 1 << 18, 1 << 21
#: Links made at once; a group of more than the second number is counted by distinct ids.
_LINKS, _WIDE_GROUP = 1 << 19, 1 << 12
#: Records of a run read at once, and runs merged in one task.
_BLOCK, MERGE_RUNS = 1 << 15, 64

# A record's key: 20 bits for each id, 24 for the document's place in its chunk.
_ID_BITS, _DOC_BITS = 20, 24
_COUNTED = np.dtype([("pair", "<u8"), ("n", "<u8")])
_JUDGED = np.dtype([("pair", "<u8"), ("n", "<u8"), ("best", "u1")])
_BACK = np.dtype([("n", "<u8"), ("best", "u1")])
# The characters with the Unicode property White_Space; and the mark that stands for a space in pieces.
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_MARK = "▁"
_ALONE = re.compile(f"(?<=[^{_BLANK}{_MARK}]) (?=[^{_BLANK}{_MARK}])")


class Pair(NamedTuple):
    """Two tokenizers as their files' contents: a JSON file of byte-level BPE and a piece model."""

    first: bytes
    second: bytes


def read_pair(first: str, second: str) -> Pair:
    return Pair(*(open(path, "rb").read() for path in (first, second)))


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 for itself, the rest from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers, made once in a task, with the bytes of every id and the ids of words met before."""

    def __init__(self, first: bytes, second: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(first.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        piece = self.b.id_to_piece
        self.bytes_b = [
            bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(_MARK, " ").encode()
            for i in range(self.b.vocab_size())
        ]
        # A piece that holds a space after something else may span two words; texts are then encoded whole.
        self.by_words = not any(_MARK in piece(i).lstrip(_MARK) for i in range(self.b.vocab_size()))
        if max(len(self.bytes_a), len(self.bytes_b)) >> _ID_BITS:
            raise ValueError("a vocabulary has more than a million ids")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # What an id is written as: with the separator of its group, and with that of its side's or group's end.
        self.text = [f"{i}," for i in range(len(self.bytes_a))] + [f"{i}|" for i in range(len(self.bytes_a))]
        self.text += [f"{i}," for i in range(len(self.bytes_b))] + [f"{i};" for i in range(len(self.bytes_b))]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.good: list[bool] = []
        self.ids = array("i"), array("i")
        self.bounds = array("q", [0]), array("q", [0])

    def learn(self, words: Sequence[str]) -> None:
        """Encode words that are not known, each as space and word, and see whether the bytes of both are those."""
        at = 0
        while at < len(words):
            to, held = at, 0
            while to < len(words) and (to == at or held < _PACK_CHARS):
                held += len(words[to])
                to += 1
            whole = [" " + w for w in words[at:to]]
            a = [e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)]
            b = self.b.encode(words[at:to], num_threads=1)
            for word, text, x, y in zip(words[at:to], whole, a, b, strict=True):
                data = text.encode()
                same = b"".join(map(self.bytes_a.__getitem__, x)) == data and b"".join(map(self.bytes_b.__getitem__, y)) == data
                self.known[word] = len(self.good)
                self.good.append(same)
                for side, own in ((0, x), (1, y)):
                    self.ids[side].extend(own)
                    self.bounds[side].append(len(self.ids[side]))
            self.chars += held
            at = to

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their texts' places, of both sides; none of texts whose bytes differ."""
        if self.chars > _KNOWN_CHARS:
            self.forget()
        words = [(words_of(t) if self.by_words else [t]) if t else () for t in texts]
        every = list(itertools.chain.from_iterable(words))
        self.learn([w for w in dict.fromkeys(every) if w not in self.known])
        codes = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        of = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        good = np.ones(len(texts), bool)
        good[of[~np.array(self.good, bool)[codes]]] = False
        codes, of = codes[good[of]], of[good[of]]
        out = []
        for ids, bounds in zip(self.ids, self.bounds, strict=True):
            bounds, ids = np.array(bounds, np.int64), np.array(ids, np.int64)
            sizes = bounds[codes + 1] - bounds[codes]
            first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            at = np.arange(int(sizes.sum())) + np.repeat(bounds[codes] - first, sizes)
            out += [ids[at], np.repeat(of, sizes)]
        return tuple(out)


def words_of(text: str) -> list[str]:
    """A text cut at single spaces between visible characters, which both tokenizers take as beginnings.

    The space goes, since encoding puts one before each word. No token of either goes on from a visible character
    to a space, so the words' tokens, one after the other, are those of the text.
    """
    return _ALONE.split(text)


class Chunk:
    """Documents that are aligned together."""

    def __init__(self) -> None:
        self.docs: list[str | None] = []
        self.chars = 0

    def add(self, text: str | None) -> None:
        self.docs.append(text)
        self.chars += len(text or "")

    @property
    def full(self) -> bool:
        return self.chars >= CHUNK_CHARS or len(self.docs) >= CHUNK_DOCS


class Aligned(NamedTuple):
    """Groups of a chunk: their documents, and where their tokens of either side begin."""

    doc: np.ndarray
    start_a: np.ndarray
    start_b: np.ndarray


def align(encoders: Encoders, a: np.ndarray, doc_a: np.ndarray, b: np.ndarray) -> Aligned:
    """Groups between the byte offsets where tokens of both sides end; both sides have the same bytes."""
    ends_a, ends_b = np.cumsum(encoders.sizes_a[a]), np.cumsum(encoders.sizes_b[b])
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last_a, last_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
    begin = lambda last: np.concatenate([[0], last + 1]).astype(np.int64)
    return Aligned(doc_a[last_a], begin(last_a), begin(last_b))


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(weights, heads)


def turned(a: np.ndarray, radix_bits: int) -> np.ndarray:
    """Ids with their lowest bits, which name the radix partition, moved to the top."""
    a = a.astype(np.uint64)
    low = a & np.uint64((1 << radix_bits) - 1)
    return (low << np.uint64(_ID_BITS - radix_bits)) | (a >> np.uint64(radix_bits))


def records(found: Aligned, a: np.ndarray, b: np.ndarray, radix_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair-document records of a chunk in order, with the links of each: keys of turned first id, second id, document."""
    side_a = turned(a, radix_bits) << np.uint64(_ID_BITS + _DOC_BITS)
    side_b = b.astype(np.uint64) << np.uint64(_DOC_BITS)
    n_a, n_b = np.diff(found.start_a), np.diff(found.start_b)
    links = n_a * n_b
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for g in np.flatnonzero(links > _WIDE_GROUP):
        x, many_x = np.unique(side_a[found.start_a[g] : found.start_a[g + 1]], return_counts=True)
        y, many_y = np.unique(side_b[found.start_b[g] : found.start_b[g + 1]], return_counts=True)
        step = max(1, _LINKS // len(y))
        for at in range(0, len(x), step):
            keys = (x[at : at + step, None] | y[None, :]).ravel() | np.uint64(found.doc[g])
            parts.append((keys, np.outer(many_x[at : at + step], many_y).ravel()))
    small = np.flatnonzero(links <= _WIDE_GROUP)
    upto = np.cumsum(links[small])
    first = 0
    while first < len(small):
        base = upto[first - 1] if first else 0
        to = max(first + 1, int(np.searchsorted(upto, base + _LINKS, "right")))
        g = np.repeat(small[first:to], links[small[first:to]])
        k = np.arange(len(g)) - np.repeat(np.concatenate([[0], upto[first : to - 1] - base]), links[small[first:to]])
        keys = side_a[found.start_a[g] + k // n_b[g]] | side_b[found.start_b[g] + k % n_b[g]] | found.doc[g].astype(np.uint64)
        parts.append(_added(keys, np.ones(len(keys), np.int64)))
        first = to
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return parts[0] if len(parts) == 1 and len(small) == len(links) else _added(*(np.concatenate(p) for p in zip(*parts, strict=True)))


def group_texts(encoders: Encoders, found: Aligned, a: np.ndarray, b: np.ndarray, n_docs: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for every document: ids of both sides, group by group; empty without tokens."""
    n_a, n_b = len(encoders.bytes_a), len(encoders.bytes_b)
    group_a, group_b = (np.repeat(np.arange(len(found.doc)), np.diff(s)) for s in (found.start_a, found.start_b))
    code_a, code_b = a.copy(), b + 2 * n_a
    code_a[found.start_a[1:] - 1] += n_a
    code_b[found.start_b[1:] - 1] += n_b
    # A token stands after those of its side and, for the first side, those of earlier groups of the other one.
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + found.start_b[group_a]] = code_a
    codes[np.arange(len(b)) + found.start_a[group_b + 1]] = code_b
    groups = np.searchsorted(found.doc, np.arange(n_docs + 1))
    bounds = (found.start_a[groups] + found.start_b[groups]).tolist()
    out = []
    for start, end in zip(bounds, bounds[1:], strict=False):
        out.append("".join(map(encoders.text.__getitem__, codes[start:end].tolist()))[:-1])
    return out


def _packed(rows: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(rows.tobytes())


def run_blocks(blob: bytes, kind: np.dtype, size: int = _BLOCK) -> Iterator[np.ndarray]:
    """Records of a run, some at a time."""
    with zstandard.ZstdDecompressor().stream_reader(blob) as stream:
        while data := stream.read(size * kind.itemsize):
            while len(data) % kind.itemsize:
                data += stream.read(kind.itemsize - len(data) % kind.itemsize)
            yield np.frombuffer(data, kind)


def merged(runs: Sequence[Iterator[np.ndarray]]) -> Iterator[np.ndarray]:
    """Records of sorted runs in order, counts of equal pairs added, with one block of every run in memory.

    The heap holds the last pair of each run's block. Up to the least of them everything has been read.
    """
    heap: list[tuple[int, int]] = []
    held: dict[int, np.ndarray] = {}

    def read(i: int) -> None:
        if (block := next(runs[i], None)) is not None:
            held[i] = block
            heapq.heappush(heap, (int(block["pair"][-1]), i))

    for i in range(len(runs)):
        read(i)
    while heap:
        bound = heap[0][0]
        parts = []
        for i, block in held.items():
            upto = int(np.searchsorted(block["pair"], np.uint64(bound), "right"))
            parts.append(block[:upto])
            held[i] = block[upto:]
        while heap and heap[0][0] == bound:
            i = heapq.heappop(heap)[1]
            del held[i]
            read(i)
        pair, n = _added(np.concatenate([p["pair"] for p in parts]), np.concatenate([p["n"] for p in parts]))
        out = np.empty(len(pair), _COUNTED)
        out["pair"], out["n"] = pair, n
        yield out


def judged(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Counted pairs in order with whether theirs is the highest count of their first id."""
    left = np.empty(0, _COUNTED)
    shift = np.uint64(_ID_BITS)

    def judge(rows: np.ndarray) -> np.ndarray:
        side = rows["pair"] >> shift
        heads = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        most = np.repeat(np.maximum.reduceat(rows["n"], heads), np.diff(np.append(heads, len(rows))))
        out = np.empty(len(rows), _JUDGED)
        out["pair"], out["n"], out["best"] = rows["pair"], rows["n"], rows["n"] == most
        return out

    for block in blocks:
        rows = np.concatenate([left, block])
        done = int(np.searchsorted(rows["pair"] >> shift, rows["pair"][-1] >> shift))
        left = rows[done:]
        if done:
            yield judge(rows[:done])
    if len(left):
        yield judge(left)


def _compressed(blocks: Iterator[np.ndarray]) -> bytes:
    packer = zstandard.ZstdCompressor(level=3).compressobj()
    return b"".join([*(packer.compress(b.tobytes()) for b in blocks), packer.flush()])


_DOC_COLUMNS = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string", "groups": "string"}
_RUN_COLUMNS = {"radix": "int", "pairs": "binary", "docs": "binary"}


def _aligner(pair, radix_bits: int, with_groups: bool, kind: pa.DataType):
    types = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}

    def rows(chunk: Chunk, ids: list, number: int, encoders: Encoders) -> Iterator[pa.RecordBatch]:
        a, doc_a, b, _ = encoders.encode(chunk.docs)
        n = len(chunk.docs)
        found = align(encoders, a, doc_a, b)
        texts = group_texts(encoders, found, a, b, n)
        n_a, n_b = np.diff(found.start_a), np.diff(found.start_b)
        per_doc = np.searchsorted(found.doc, np.arange(n + 1))

        def total(x: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(x)])
            return (sums[per_doc[1:]] - sums[per_doc[:-1]]).astype(np.int64)

        columns = {
            "chunk": pa.array(np.full(n, number)), "place": pa.array(np.arange(n)), "doc_id": pa.array(ids, kind),
            "n_a": pa.array(total(n_a)), "n_b": pa.array(total(n_b)), "n_groups": pa.array(np.diff(per_doc)), "n_links": pa.array(total(n_a * n_b)),
            "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts], pa.string()),
            "groups": pa.array(texts if with_groups else [None] * n, pa.string()),
        }
        empty = {c: pa.nulls(n, types[t]) for c, t in _RUN_COLUMNS.items()}
        yield pa.RecordBatch.from_pydict(columns | empty)
        keys, links = records(found, a, b, radix_bits)
        shift = np.uint64(2 * _ID_BITS + _DOC_BITS - radix_bits)
        cuts = np.searchsorted(keys >> shift, np.arange((1 << radix_bits) + 1, dtype=np.uint64))
        for radix in np.flatnonzero(np.diff(cuts)):
            own, times = keys[cuts[radix] : cuts[radix + 1]], links[cuts[radix] : cuts[radix + 1]]
            pairs = own >> np.uint64(_DOC_BITS)
            heads = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            counted = np.empty(len(heads), _COUNTED)
            counted["pair"], counted["n"] = pairs[heads], np.diff(np.append(heads, len(own)))
            docs = (own & np.uint64((1 << _DOC_BITS) - 1)).astype(np.uint32)
            both = np.concatenate([[np.uint32(len(heads))], counted["n"].astype(np.uint32), docs, times.astype(np.uint32)])
            run = {"radix": pa.array([radix], pa.int32()), "pairs": pa.array([_packed(counted)]), "docs": pa.array([_packed(both)])}
            place = {"chunk": pa.array([number]), "place": pa.nulls(1, pa.int64()), "doc_id": pa.nulls(1, kind)}
            yield pa.RecordBatch.from_pydict(place | {c: pa.nulls(1, types[t]) for c, t in _DOC_COLUMNS.items()} | run)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(*pair.value)
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        chunk, ids = Chunk(), []
        for batch in batches:
            texts = batch.column(1)
            for i in range(len(texts)):
                chunk.add(texts[i].as_py())
                ids.append(batch.column(0)[i].as_py())
                if chunk.full:
                    yield from rows(chunk, ids, next(numbers), encoders)
                    chunk, ids = Chunk(), []
        if chunk.docs:
            yield from rows(chunk, ids, next(numbers), encoders)

    return work


def _merge(rows: pa.Table) -> pa.Table:
    """One run of the runs of a group, by a heap merge."""
    runs = [run_blocks(x.as_py(), _COUNTED) for x in rows.column("pairs")]
    return rows.slice(0, 1).select(["radix"]).append_column("pairs", pa.array([_compressed(merged(runs))], pa.binary()))


def _judge(rows: pa.Table) -> pa.Table:
    """The whole partition's pairs, counted and judged."""
    runs = [run_blocks(x.as_py(), _COUNTED) for x in rows.column("pairs")]
    return rows.slice(0, 1).select(["radix"]).append_column("judged", pa.array([_compressed(judged(merged(runs)))], pa.binary()))


def _stream_back(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """For every run its pairs' counts over the corpus, in the run's order."""
    known = np.concatenate([np.empty(0, _JUDGED), *(b for x in counts.column("judged") for b in run_blocks(x.as_py(), _JUDGED))])

    def back(blob: bytes) -> Iterator[np.ndarray]:
        for block in run_blocks(blob, _COUNTED):
            at = np.searchsorted(known["pair"], block["pair"])
            out = np.empty(len(block), _BACK)
            out["n"], out["best"] = known["n"][at], known["best"][at]
            yield out

    answers = [_compressed(back(x.as_py())) for x in runs.column("pairs")]
    return pa.table({"chunk": runs.column("chunk"), "radix": runs.column("radix"), "counts": pa.array(answers, pa.binary())})


def _sum_up(docs: pa.Table, runs: pa.Table) -> pa.Table:
    """The documents of a chunk with what the counts of its runs give them."""
    best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
    own: dict[int, dict[str, bytes]] = {}
    for radix, name, blob in zip(*(runs.column(c).to_pylist() for c in ("radix", "kind", "blob")), strict=True):
        own.setdefault(radix, {})[name] = blob
    unpack = zstandard.ZstdDecompressor().decompressobj
    for run in own.values():
        body = np.frombuffer(unpack().decompress(run["docs"]), np.uint32)
        back = np.frombuffer(unpack().decompress(run["counts"]), _BACK)
        n = int(body[0])
        sizes, rest = body[1 : n + 1], body[n + 1 :]
        doc, times = rest[: len(rest) // 2], rest[len(rest) // 2 :].astype(np.int64)
        np.add.at(total, doc, times * np.repeat(back["n"].astype(np.int64), sizes))
        np.add.at(best, doc, times * np.repeat(back["best"].astype(np.int64), sizes))
    place = docs.column("place").to_numpy()
    return docs.append_column("n_best", pa.array(best[place])).append_column("count_sum", pa.array(total[place]))


def align_tokens(docs: DataFrame, pair: Pair, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = True) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups, n_best, count_sum.

    The first tokenizer encodes a space and the text, the second, which puts a space before, the text; special tokens do not exist. Offsets where
    tokens of both end cut both into groups, and every token of a group's first side is linked with every one of its second.
    A pair of ids counts the documents that hold it linked. ``n_best`` is the number of links whose count is the highest of
    their first id, ties included, ``count_sum`` the sum of all links' counts. ``groups`` reads ``a1,a2|b1;a3|b2``;
    it is null unless ``with_groups``. Null and empty texts, and those that either tokenizer's bytes do not give back, have
    no tokens: zeros, and an empty ``groups_sha256``. Every row is a document of its own, whether or not ids or texts repeat.
    Ids may be null; other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "align")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    radix_bits = min(max(3, math.ceil(math.log2(partitions))), 10)
    sent = spark.sparkContext.broadcast(tuple(pair))
    both = {"chunk": "bigint", "place": "bigint", "doc_id": id_type.simpleString()} | _DOC_COLUMNS | _RUN_COLUMNS
    worker = _aligner(sent, radix_bits, with_groups, to_arrow_type(id_type))
    made = materialize(rows.mapInArrow(worker, ", ".join(f"{c} {t}" for c, t in both.items())), "chunks", folder)
    found = made.where("radix is null").select("chunk", "place", "doc_id", *_DOC_COLUMNS)
    runs = made.where("radix is not null")

    chunks = runs.select("chunk").distinct().count()
    salts = max(1, math.ceil(chunks / MERGE_RUNS))
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt")
    heads = runs.select("chunk", "radix", "pairs", salt)
    merged_once = heads.groupBy("radix", "salt").applyInArrow(_merge, "radix int, pairs binary")
    counts = materialize(merged_once.groupBy("radix").applyInArrow(_judge, "radix int, judged binary"), "counts", folder)
    copies = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    back = heads.groupBy("radix", "salt").cogroup(copies.groupBy("radix", "salt")).applyInArrow(
        _stream_back, "chunk bigint, radix int, counts binary"
    )
    back = materialize(back, "back", folder)
    blobs = [
        runs.select("chunk", "radix", F.lit("docs").alias("kind"), F.col("docs").alias("blob")),
        back.select("chunk", "radix", F.lit("counts").alias("kind"), F.col("counts").alias("blob")),
    ]
    out = ", ".join(f"{c} {t}" for c, t in found.dtypes) + ", n_best bigint, count_sum bigint"
    summed = found.groupBy("chunk").cogroup(blobs[0].unionByName(blobs[1]).groupBy("chunk")).applyInArrow(_sum_up, out)
    done = materialize(summed.drop("chunk", "place"), "alignment")
    discard(spark, folder)
    return done
