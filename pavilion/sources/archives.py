"""JSON documents inside zip archives, read in parallel below the archive level."""

from __future__ import annotations

import itertools
import math
import re
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pavilion.sources.tables import parsed_documents

_BATCH_BYTES = 8 << 20
_SLICE = 10_000
_PIECES = 32  # pieces of neighbouring entries that a task reads on average, so that the tasks come out alike
_ENTRY = ["archive", "entry", "start", "packed", "method", "crc"]
_RANGE = 1 << 20  # bytes of a directory, or of neighbouring entries, read at once
_GAP = 4 << 10  # bytes between two entries that are read rather than skipped
_SLACK = 256  # bytes before an entry's content that its line of the directory does not tell: long letters, extra fields

# Layouts and marks of the zip format. An entry's local header, its header in the directory, the
# directory's end, and the 64-bit record of the end with its locator.
_LOCAL_HEADER, _LOCAL_SIZE, _LOCAL_MARK = "<4s5H3L2H", 30, b"PK\x03\x04"
_ENTRY_HEADER, _ENTRY_SIZE, _ENTRY_MARK = "<4s6H3L5H2L", 46, b"PK\x01\x02"
_END, _END_SIZE, _COMMENT_MAX = b"PK\x05\x06", 22, 0xFFFF
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_UTF8, _DATE = 0x800, 0x21  # the flag of names in UTF-8, and the first day of 1980

# Send these functions to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path in it."""
    # File listings give plain paths, Arrow wants them encoded; it knows the object store by its plain scheme.
    return pyarrow.fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe="/:"))


def _open(path: str):
    filesystem, inner = file_system(path)
    return filesystem.open_input_file(inner)


def directory_place(file, size: int) -> tuple[int, int, int]:
    """Where an archive's directory starts and ends, and what to add to the offsets it names.

    Read from the end of the file, the 64-bit record of large archives included. Bytes put before an
    archive move everything by their number.
    """
    before = max(0, size - _END_SIZE - _COMMENT_MAX)
    tail = file.read_at(size - before, before)
    # The comment may hold the mark too; the record's own says how long the comment is.
    marks = [m.start() for m in re.finditer(re.escape(_END), tail) if len(tail) - m.start() >= _END_SIZE]
    ends = {m: struct.unpack_from("<4s4H2LH", tail, m) for m in marks}
    exact = [m for m in marks if m + _END_SIZE + ends[m][-1] == len(tail)]
    if not marks:
        raise zipfile.BadZipFile("the end of the archive's directory was not found")
    at = max(exact or marks)
    *_, entries, length, start, _ = ends[at]
    end = before + at
    locator = file.read_at(20, end - 20) if end >= 20 else b""
    if locator[:4] == _LOCATOR64 and (entries == 0xFFFF or 0xFFFFFFFF in (length, start)):
        named = struct.unpack("<8xQ4x", locator)[0]
        # The record lies right before its locator; where it is named tells what was put before the archive.
        found = file.read_at(56, named) if named + 56 <= size else b""
        if found[:4] != _END64:
            found = file.read_at(56, end - 20 - 56)
        if found[:4] != _END64:
            raise zipfile.BadZipFile("the 64-bit end of the archive's directory was not found")
        length, start = struct.unpack("<40x2Q", found)
        end = end - 20 - (12 + struct.unpack("<4xQ", found[:12])[0])
    moved = end - length - start
    if moved < 0:
        raise zipfile.BadZipFile("the archive's directory does not fit into the file")
    return start + moved, end, moved


def directory_entries(file, start: int, end: int, moved: int, range_bytes: int = _RANGE) -> Iterator[tuple[str, int, int, int, int]]:
    """(name, offset, packed size, method, checksum) of an archive's entries, read range by range.

    Only one range is held, and what of an entry it cuts off.
    """
    left, at = b"", start
    while at < end or left:
        data = left + file.read_at(min(range_bytes, end - at), at) if at < end else left
        at, place = min(end, at + range_bytes), 0
        while len(data) - place >= _ENTRY_SIZE:
            head = struct.unpack_from(_ENTRY_HEADER, data, place)
            signature, _, _, flags, method, _, _, crc, packed, plain, name_length, extra_length, comment_length, *_, offset = head
            if signature != _ENTRY_MARK:
                raise zipfile.BadZipFile("the archive's directory is damaged")
            whole = _ENTRY_SIZE + name_length + extra_length + comment_length
            if len(data) - place < whole:
                break
            first = place + _ENTRY_SIZE
            name = data[first : first + name_length].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[first + name_length : first + name_length + extra_length]
            packed, offset = _wide(extra, plain, packed, offset)
            yield name, offset + moved, packed, method, crc
            place += whole
        left = data[place:]
        if at >= end and left:
            raise zipfile.BadZipFile("the archive's directory ends inside an entry")


def _wide(extra: bytes, plain: int, packed: int, offset: int) -> tuple[int, int]:
    """Packed size and offset, taken from the 64-bit field where the short ones are full."""
    at = 0
    while len(extra) - at >= 4:
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            if plain == 0xFFFFFFFF:
                next(wide, None)
            packed = next(wide, packed) if packed == 0xFFFFFFFF else packed
            offset = next(wide, offset) if offset == 0xFFFFFFFF else offset
        at += 4 + size
    return packed, offset


def _list_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["archive"]:
            with _open(path) as file:
                found = directory_entries(file, *directory_place(file, file.size()))
                rows = ((path, *entry) for entry in found if entry[0].endswith(".json"))
                while slice_ := list(itertools.islice(rows, _SLICE)):
                    yield pd.DataFrame(slice_, columns=_ENTRY)


def _run(rows: Sequence[tuple], first: int) -> tuple[int, int]:
    """The row behind the run of neighbouring entries that starts at row ``first``, and the run's bytes."""
    archive, _, at, *_ = rows[first]
    end, i = at, first
    while i < len(rows):
        other, entry, start, packed, *_ = rows[i]
        reach = start + _LOCAL_SIZE + len(entry) + packed + _SLACK
        if i > first and (other != archive or not at <= start <= end + _GAP or reach - at > _RANGE):
            break
        end, i = max(end, reach), i + 1
    return i, end - at


def _read_entry(file, data: bytes, at: int, start: int, packed: int, method: int, crc: int) -> str:
    """An entry's content; ``data`` is what of the file lies from ``at`` on."""
    name_length, extra_length = struct.unpack_from("<26x2H", data, start - at)
    first = start - at + _LOCAL_SIZE + name_length + extra_length
    content = data[first : first + packed]
    if len(content) < packed:
        content = file.read_at(packed, at + first)
    if method == zipfile.ZIP_DEFLATED:
        content = zlib.decompress(content, -zlib.MAX_WBITS)
    elif method != zipfile.ZIP_STORED:
        raise ValueError(f"zip method {method} is not supported")
    if zlib.crc32(content) != crc:
        raise zipfile.BadZipFile("an entry's content does not match its checksum")
    return content.decode("utf-8")


def _read_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, file = None, None
    for batch in batches:
        rows = list(batch.to_pandas()[_ENTRY].itertuples(index=False, name=None))
        names = [batch.column("archive"), batch.column("entry")]
        texts, size, sent, behind = [], 0, 0, 0
        for i, (archive, _, start, *packing) in enumerate(rows):
            if archive != current:
                if file is not None:
                    file.close()
                current, file = archive, _open(archive)
            if i == behind:
                behind, length = _run(rows, i)
                data, at = file.read_at(length, start), start
            text = _read_entry(file, data, at, start, *packing)
            texts.append(text)
            size += len(text)
            if size >= _BATCH_BYTES or i + 1 == len(rows):
                columns = [*(n.slice(sent, len(texts)) for n in names), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["archive", "entry", "text"])
                texts, size, sent = [], 0, i + 1
    if file is not None:
        file.close()


def scan_zip_entries(spark: SparkSession, path: str, chunk_bytes: int = 32 << 20) -> DataFrame:
    """(archive, entry, text) of every ``*.json`` entry of the archives under ``path``.

    One step reads only the archives' directories, range by range; the entries are then spread in
    pieces of neighbouring entries, so that one large archive is read by many
    tasks and no archive is ever held whole. The number of tasks follows the
    archives' sizes, one for ``chunk_bytes``: the shuffled entry list is far smaller than the data behind
    it, and Spark would merge its partitions if left to choose. A piece is a small part of a chunk: whole
    chunks, hashed, would leave tasks with several and others with none. A task holds a range of a
    directory and a slice of entries, whatever the number of entries, and reads entries that lie side by side at once, a
    range at a time. An entry whose checksum does not fit fails the job.
    Archives are opened by Arrow's file systems: local or mounted paths, HDFS and S3.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    packed_bytes = files.agg(F.sum("length")).first()[0] or 0  # file listing only
    tasks = max(math.ceil(packed_bytes / chunk_bytes), spark.sparkContext.defaultParallelism)
    entries = files.select(F.col("path").alias("archive")).mapInPandas(
        _list_entries, "archive string, entry string, start bigint, packed bigint, method int, crc bigint"
    )
    piece = F.floor(F.col("start") / F.lit(max(chunk_bytes // _PIECES, 1)))
    spread = entries.repartition(tasks, "archive", piece).sortWithinPartitions("archive", "start")
    return spread.mapInArrow(_read_entries, "archive string, entry string, text string")


def scan_zip_json(
    spark: SparkSession, path: str, schema: T.StructType, key: str = "match_id"
) -> DataFrame:
    """The documents in the archives, parsed, with the entry's base name as ``key``.

    ``corrupt`` has the text of a document that is no valid JSON; see ``tables.parsed_documents``.
    """
    entries = scan_zip_entries(spark, path)
    base = F.regexp_replace(F.element_at(F.split("entry", "/"), -1), r"\.json$", "")
    return parsed_documents(entries, "text", schema, base.alias(key))


def write_zip(out, entries: Iterable[tuple[str, bytes]], start: int = 0) -> int:
    """Write (name, content) entries as one archive, deflated, and return their number.

    For small documents the standard library's writer takes longer than the compression. Held are a range
    of the archive and its directory in bytes. All entries have the same date, so a retried task writes the same
    archive. ``start`` is where in ``out`` the archive begins.
    """
    buffer, directory, written, count = bytearray(), bytearray(), start, 0
    for name, content in entries:
        encoded, packed = name.encode(), zlib.compress(content, wbits=-zlib.MAX_WBITS)
        sizes = zlib.crc32(content), len(packed), len(content), len(encoded)
        fields = 20, _UTF8, zipfile.ZIP_DEFLATED, 0, _DATE, *sizes
        at = written + len(buffer)
        wide = struct.pack("<2HQ", 1, 8, at) if at >= 0xFFFFFFFF else b""
        directory += struct.pack(_ENTRY_HEADER, _ENTRY_MARK, 20, *fields, len(wide), 0, 0, 0, 0, min(at, 0xFFFFFFFF))
        directory += encoded + wide
        buffer += struct.pack(_LOCAL_HEADER, _LOCAL_MARK, *fields, 0) + encoded + packed
        count += 1
        if len(buffer) >= _RANGE:
            out.write(bytes(buffer))
            written += len(buffer)
            buffer.clear()
    at, size = written + len(buffer), len(directory)
    out.write(bytes(buffer))
    out.write(bytes(directory))
    if count >= 0xFFFF or at >= 0xFFFFFFFF or size >= 0xFFFFFFFF:
        out.write(struct.pack("<4sQ2H2L4Q", _END64, 44, 45, 45, 0, 0, count, count, size, at))
        out.write(struct.pack("<4sLQL", _LOCATOR64, 0, at + size, 1))
    short = min(count, 0xFFFF)
    out.write(struct.pack("<4s4H2LH", _END, 0, 0, short, short, min(size, 0xFFFFFFFF), min(at, 0xFFFFFFFF), 0))
    return count
