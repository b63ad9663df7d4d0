"""Spark session defaults and the shared folder for tables a job must pin down."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call-site capture costs a round trip to the JVM for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Folders of local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def shuffle_partitions(data_bytes: int, partition_bytes: int = 512 << 20) -> int:
    """Partitions that keep each shuffled one near ``partition_bytes``; Spark merges small ones."""
    return max(math.ceil(data_bytes / partition_bytes), 200)


def build_session(
    app: str = "pavilion",
    master: str | None = None,
    data_bytes: int | None = None,
    partition_bytes: int = 512 << 20,
    **conf: str,
) -> SparkSession:
    """Session with the defaults the jobs assume; keyword names use ``__`` for dots.

    ``data_bytes``, the size of the largest input, sets the number of shuffle partitions,
    so that each holds about ``partition_bytes``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if data_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(data_bytes, partition_bytes))
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without the setting, as in tests, gets a fresh temporary folder; a cluster
    session without it is an error, because a machine-local folder would not
    survive the loss of that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if ":/" not in folder:
            # Spark keeps a qualified sub-folder of the same setting.
            folder = spark.sparkContext.getCheckpointDir() or folder
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="pavilion-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a result must not be computed twice with different task layouts.
    The table outlives lost executors and cuts the lineage. ``folder`` puts it under
    a folder of the caller's, which the caller discards.
    """
    path = f"{folder}/{label}-{uuid.uuid4().hex}" if folder else new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete folders that ``new_folder`` named, once nothing reads them any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Spark's cleaner follows the driver's garbage collection, which may not come for a long time in a
    job of many stages; meanwhile the executors' disks hold the files of every stage before.
    """
    gc.collect()
    spark._jvm.System.gc()
