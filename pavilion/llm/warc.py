"""WARC archives with a two-level capture index.

Every task writes archives of single gzip members, one per record, and reports where each lies. The
index sorts captures by reversed-host key, range by range; each range is a file of compressed
blocks of sorted lines, followed by its sparse directory (the first key of every block). A lookup
finds the range among the ranges' first keys, the block in the directory and the line in the block,
each by bisection, and then reads one byte range of the archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import math
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from pavilion.session import materialize, new_folder

_GZIP = 31  # window bits of zlib for a gzip member
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    # Folders are given plain, Arrow wants them encoded; it knows the object store by its plain scheme.
    return pyarrow.fs.FileSystem.from_uri(quote(uri.replace("s3a://", "s3://", 1), safe="/:"))


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``http://a.example.org/x?y`` gives ``org,example,a)/x?y``."""
    if not url:
        return ""
    try:
        cut = urlsplit(url.strip())
        host = (cut.hostname or "").removeprefix("www.")
    except ValueError:  # not a URL: the text itself is the key
        return url.strip().lower()
    port = f":{cut.netloc.rpartition(':')[2]}" if cut.netloc.rpartition(":")[2].isdigit() and ":" in cut.netloc else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (cut.path or "/").lower() + (f"?{cut.query.lower()}" if cut.query else "")


def _header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record as bytes; a revisit has the response's header only."""
    body = (_HTTP % len(payload)).encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:x-page:{page_id}>")]
    if url:
        # Control characters and blanks would end the header line.
        fields.append(("WARC-Target-URI", "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)))
    fields += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return _header(fields) + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """What ``record`` wrote; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        text = fields.get(name, "<urn:x-page:None>").removeprefix("<urn:x-page:").removesuffix(">")
        return None if text == "None" else int(text)

    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def _writer(folder: str, archive_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, name, at = None, "", 0
        for batch in batches:
            places: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            payloads = batch.column(2)
            for i, (page_id, url, digest, refers_to, revisit) in enumerate(zip(*columns, strict=True)):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    # A name of its own for each attempt: the index knows those of the attempt that counted.
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                raw = record(page_id, url, bytes(payloads[i].as_buffer()), digest, refers_to, revisit)
                packed = packer.compress(raw) + packer.flush()
                out.write(packed)
                places.append((url_key(url), page_id, name, at, len(packed)))
                at += len(packed)
            columns = list(zip(*places, strict=True)) if places else [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "page_id", "file", "start", "size"]
            )
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 1 << 30, min_revisit_bytes: int = 1000, level: int = 1) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder``; returns the captures' places.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, that with the largest page id is
    the response and the others revisit it. A null html is an empty payload. A row without
    an id revisits a response with an id, or else is a response; repeated rows with the
    largest id are all responses. Other columns are not read.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    large = pages.where(F.octet_length("payload") >= min_revisit_bytes)
    repeated = large.groupBy("digest").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n")).where("n > 1 and newest is not null")
    repeated = materialize(repeated.select("digest", "newest"), "repeated", folder)
    store, root = _store(f"{folder}/archives")
    store.create_dir(root, recursive=True)
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    rows = pages.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("newest")).alias("refers_to"), revisit.alias("revisit")
    )
    scheme = "key string, page_id bigint, file string, start bigint, size bigint"
    return materialize(rows.mapInArrow(_writer(f"{folder}/archives", archive_bytes, level), scheme), "captures", folder)


def _sort_key(key: str, page_id: int | None) -> str:
    """Text that sorts like (key, page id), null first; ids in twenty digits, moved to be positive."""
    return f"{key}\x00" + ("" if page_id is None else f"{page_id + (1 << 63):020d}")


def _indexer(folder: str, block_lines: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, out, at, directory, lines = f"{uuid.uuid4().hex}.idx", None, 0, [], []

        def flush() -> None:
            nonlocal at, lines
            packed = zlib.compress("\n".join(lines).encode())
            out.write(packed)
            directory.append([json.loads(lines[0])[0], at, len(packed)])
            at, lines = at + len(packed), []

        for batch in batches:
            for key, page_id, file, start, size in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                out = out or store.open_output_stream(posixpath.join(root, name), compression=None)
                lines.append(json.dumps([_sort_key(key, page_id), file, start, size]))
                if len(lines) == block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            packed = zlib.compress(json.dumps(directory).encode())
            out.write(packed + len(packed).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_pylist([{"first": directory[0][0], "file": name}])

    return index


def _tasks(captures: DataFrame, task_bytes: int = 64 << 20) -> int:
    """Tasks by the bytes that stand behind the captures, which Spark does not see, and one for each core at least."""
    size = captures.agg(F.sum("size")).first()[0] or 0
    return max(math.ceil(size / task_bytes), captures.sparkSession.sparkContext.defaultParallelism)


def write_index(captures: DataFrame, folder: str, block_lines: int = 1024) -> list[tuple[str, str]]:
    """Write the two-level index of ``captures``; returns its ranges as (first key, file), in order.

    One range per task, as many as the archives' bytes ask for.
    """
    store, root = _store(f"{folder}/index")
    store.create_dir(root, recursive=True)
    order = ["key", F.col("page_id").asc_nulls_first(), "file", "start"]
    rows = captures.select("key", "page_id", "file", "start", "size")
    ordered = rows.repartitionByRange(_tasks(captures), *order).sortWithinPartitions(*order)
    made = materialize(ordered.mapInArrow(_indexer(f"{folder}/index", block_lines), "first string, file string"), "ranges", folder)
    return sorted((r["first"], r["file"]) for r in made.collect())


class Range:
    """One range of the index, opened for lookups; blocks are read when they are needed."""

    def __init__(self, store: pyarrow.fs.FileSystem, path: str) -> None:
        self.file = store.open_input_file(path)
        end = self.file.size()
        size = int.from_bytes(self.file.read_at(8, end - 8), "big")
        self.directory = json.loads(zlib.decompress(self.file.read_at(size, end - 8 - size)))
        self.firsts = [row[0] for row in self.directory]
        self.number, self.lines, self.keys = -1, [], []

    def find(self, key: str) -> Iterator[list]:
        """All lines with this key."""
        block = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        while block < len(self.directory) and self.firsts[block] <= key:
            if block != self.number:
                _, start, size = self.directory[block]
                self.lines = [json.loads(x) for x in zlib.decompress(self.file.read_at(size, start)).decode().split("\n")]
                self.number, self.keys = block, [x[0] for x in self.lines]
            yield from self.lines[bisect.bisect_left(self.keys, key) : bisect.bisect_right(self.keys, key)]
            block += 1


def _reader(folder: str, ranges, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        firsts, opened, files = [r[0] for r in ranges.value], (-1, None), {}
        kinds = [
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
        ]
        for batch in batches:
            places = []
            for key in map(_sort_key, batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = max(bisect.bisect_left(firsts, key) - 1, 0)
                while at < len(firsts) and firsts[at] <= key:
                    if opened[0] != at:
                        opened = at, Range(store, posixpath.join(root, "index", ranges.value[at][1]))
                    places += [(file, start, size) for _, file, start, size in opened[1].find(key)]
                    at += 1
            found, held = [], 0
            for file, start, size in sorted(places):
                if file not in files:
                    if len(files) >= 16:
                        files.pop(next(iter(files))).close()
                    files[file] = store.open_input_file(posixpath.join(root, "archives", file))
                row = parse_record(zlib.decompress(files[file].read_at(size, start), _GZIP))
                found.append(row if with_payload else row | {"payload": None})
                held += size
                if held > 1 << 23:
                    yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))
                    found, held = [], 0
            yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))

    return read


def read_captures(
    wanted: DataFrame, folder: str, ranges: list[tuple[str, str]], with_payload: bool = True, tasks: int | None = None
) -> DataFrame:
    """Records of the captures whose (key, page_id) are in ``wanted``, read through the index.

    Equal wanted rows count once. Wanted rows are sorted by key over the ``tasks``, so that a task
    opens few ranges; the archives are read by byte range. Without a number Spark deals the keys, which are
    small, to as many tasks as it likes.
    """
    spark = wanted.sparkSession
    held = spark.sparkContext.broadcast(ranges)
    order = ["key", F.col("page_id").asc_nulls_first()]
    asked = wanted.select("key", "page_id").distinct().repartitionByRange(*([tasks] if tasks else []), *order).sortWithinPartitions(*order)
    return asked.mapInArrow(
        _reader(folder, held, with_payload),
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary",
    )


def archive_round_trip(pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write all pages, index them, and read every capture back through the index.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, payload. See
    ``write_archives`` for nulls and ties; a page without a URL is indexed under the empty key.
    """
    folder = new_folder(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, **options)
    ranges = write_index(captures, folder)
    return read_captures(captures, folder, ranges, with_payload, _tasks(captures))
