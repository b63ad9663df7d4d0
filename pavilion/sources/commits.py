"""Many tables, one commit: write, audit, publish.

A run writes every table, or partition of one, into a folder of its own that nothing else uses and nobody reads
yet. Publishing adds one small file, the next manifest, which names for every table the folders that count; it is put
in place by a rename that fails if another run was first. Readers resolve the newest manifest, so they see all tables of a
run or none, and a run that fails between two tables leaves the tables of the run before readable.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pavilion.operators.quality import Check, with_reasons
from pavilion.session import discard
from pavilion.sources.tables import DATE_COLUMN, date_partition, table_writer

RUN, VERDICT = "run", "verdict"
VALID, REJECTED = "valid", "rejected"
_WHOLE = ""  # the partition name of a table without dates


class ConflictError(RuntimeError):
    """Another run published first."""


@dataclass(frozen=True)
class Part:
    """One folder of a table: ``base`` is the root below which the path names partitions; a verdict picks its rows."""

    folder: str
    base: str
    verdict: str | None = None


@dataclass(frozen=True)
class Manifest:
    """The folders that count, by table and date; version 0 is the state before any run."""

    version: int = 0
    tables: Mapping[str, Mapping[str, Part]] = field(default_factory=dict)

    def text(self) -> str:
        parts = {t: {p: [x.folder, x.base, x.verdict] for p, x in sorted(own.items())} for t, own in sorted(self.tables.items())}
        return json.dumps({"version": self.version, "tables": parts}, indent=1)

    @staticmethod
    def of(text: str) -> Manifest:
        read = json.loads(text)
        return Manifest(read["version"], {t: {p: Part(*x) for p, x in own.items()} for t, own in read["tables"].items()})


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions whose manifests are kept under ``root``, ascending."""
    fs, place = _file_system(spark, root)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:010d}.json"


def published(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The newest manifest, or that of a version."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return Manifest()
    fs, place = _file_system(spark, _manifest_path(root, version))
    stream = fs.open(place)
    try:
        return Manifest.of(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Add the manifest under its version; fails if that version exists."""
    jvm = spark._jvm
    temporary = f"{root.rstrip('/')}/.{uuid.uuid4().hex}"
    fs, place = _file_system(spark, temporary)
    stream = fs.create(place)
    stream.write(bytearray(manifest.text().encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(place, jvm.org.apache.hadoop.fs.Path(_manifest_path(root, manifest.version)), options)
    except Exception as error:
        fs.delete(place, False)
        if "FileAlreadyExists" in str(error):
            raise ConflictError(f"version {manifest.version} of {root} was published by another run") from error
        raise


def _read_parts(spark: SparkSession, parts: Mapping[str, Part], schema: T.StructType | None) -> DataFrame:
    """The rows of a table's parts, with ``ingestion_date`` where it has dates."""
    some = next(iter(parts.values()))
    reader = spark.read.option("basePath", some.base)
    if schema is not None:
        own = [f for f in schema.fields if f.name not in (DATE_COLUMN, VERDICT)]
        more = [T.StructField("reasons", T.ArrayType(T.StringType()))] if some.verdict == REJECTED else []
        verdict = [T.StructField(VERDICT, T.StringType())] if some.verdict else []
        date = [T.StructField(DATE_COLUMN, T.DateType())] if _WHOLE not in parts else []
        reader = reader.schema(T.StructType([*own, *more, *verdict, *date]))
    df = reader.parquet(*[p.folder for p in parts.values()])
    if some.verdict:
        if VERDICT not in df.columns:  # nothing was written, neither valid nor rejected
            df = df.withColumn(VERDICT, F.lit(None).cast("string"))
        df = df.where(F.col(VERDICT) == some.verdict)
        df = df.drop(VERDICT, *(["reasons"] if some.verdict == VALID else []))
    return df.drop(RUN)


def read(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    dates: Sequence[dt.date] | None = None,
    manifest: Manifest | None = None,
) -> DataFrame:
    """A published table, or some of its ingestion dates; only their folders are listed and read.

    Several tables that must fit each other are read with one ``manifest``.
    """
    parts = (manifest or published(spark, root)).tables.get(table)
    if parts and dates is not None:
        wanted = {f"{d:%Y-%m-%d}" for d in dates}
        parts = {d: p for d, p in parts.items() if d in wanted}
    if not parts:
        raise LookupError(f"{table} has not been published in {root}" if dates is None else f"{table} has no part of {dates}")
    return _read_parts(spark, parts, schema)


class Run:
    """Tables written aside and published together; a context that deletes what it has not published.

    ``root`` holds the manifests; a table is named by its own root folder.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.before = published(spark, root)
        self.name = f"r{uuid.uuid4().hex}"
        self.written: dict[str, dict[str, Part]] = {}
        self._folders: list[str] = []

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        discard(self.spark, *self._folders)

    def _folder(self, table: str, date: dt.date | None) -> str:
        own = f"{table.rstrip('/')}/{RUN}={self.name}"
        self._folders.append(own)
        return f"{own}/{date_partition(date)}" if date is not None else own

    def _add(self, table: str, date: dt.date | None, part: Part) -> None:
        self.written.setdefault(table, {})[_WHOLE if date is None else f"{date:%Y-%m-%d}"] = part

    def write(self, table: str, df: DataFrame, date: dt.date | None = None, **options) -> DataFrame:
        """Write a whole table, or one ingestion date of it; returns the written rows.

        ``options`` are those of ``tables.write_partition``. An empty frame empties its date.
        """
        folder = self._folder(table, date)
        table_writer(df.drop(DATE_COLUMN) if date is not None else df, **options).parquet(folder)
        self._add(table, date, Part(folder, table.rstrip("/")))
        return self.spark.read.schema(df.drop(DATE_COLUMN).schema if date is not None else df.schema).parquet(folder)

    def write_split(self, table: str, rejects: str, df: DataFrame, checks: Sequence[Check], date: dt.date, **options) -> None:
        """Write the rows that pass all checks to ``table`` and the others, with their reasons, to ``rejects``.

        One write, partitioned by the verdict, of which both tables are parts: the rows are computed and judged once.
        """
        marked = with_reasons(df.drop(DATE_COLUMN), checks)
        verdict = F.when(F.size("reasons") == 0, VALID).otherwise(REJECTED)
        folder = self._folder(table, date)
        table_writer(marked.withColumn(VERDICT, verdict), **options).partitionBy(VERDICT).parquet(folder)
        for name, kind in ((table, VALID), (rejects, REJECTED)):
            self._add(name, date, Part(folder, table.rstrip("/"), kind))

    def _parts(self, table: str) -> dict[str, Part]:
        new, old = self.written.get(table, {}), dict(self.before.tables.get(table, {}))
        # A table is either whole or dated; what is written as the other kind takes the place of all of it.
        if new and (_WHOLE in new) != (_WHOLE in old):
            old = {}
        return old | new

    def read(self, table: str, schema: T.StructType | None = None, dates: Sequence[dt.date] | None = None) -> DataFrame:
        """A table as it would be after publishing."""
        seen = Manifest(tables={table: self._parts(table)} if self._parts(table) else {})
        return read(self.spark, self.root, table, schema, dates, seen)

    def publish(self) -> int:
        """Make all written tables visible at once; returns the new version.

        Fails, and leaves everything as it was, if another run has published since this one began.
        """
        tables = dict(self.before.tables) | {t: self._parts(t) for t in self.written}
        manifest = replace(self.before, version=self.before.version + 1, tables=tables)
        _put(self.spark, self.root, manifest)
        self._folders.clear()
        return manifest.version


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete folders that only manifests older than the last ``keep`` name, and those manifests; returns the folders.

    Folders of runs that were killed are in no manifest and stay; each is named by its run.
    """
    if keep < 1:
        raise ValueError("the newest manifest must be kept")
    known = versions(spark, root)
    old, kept = known[:-keep], known[-keep:]
    folders = lambda version: {p.folder for own in published(spark, root, version).tables.values() for p in own.values()}
    live = set().union(*map(folders, kept)) if kept else set()
    gone = sorted(set().union(*map(folders, old)) - live) if old else []
    discard(spark, *gone, *[_manifest_path(root, v) for v in old])
    return gone
