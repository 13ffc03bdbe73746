"""Session helpers: UTC timestamps and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings the loads rely on: UTC instants, the last of repeated JSON keys, overwrites that replace only the
    partitions they write to, and tasks that write a few partitions side by side instead of sorting all their rows first."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    return spark


@contextmanager
def files_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Within, files are written with so many rows at most."""
    most = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(most)
    if rows:
        spark.conf.set(most, rows)
    try:
        yield
    finally:
        spark.conf.set(most, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that survives the loss of an executor.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and Spark
    runs in this process (unit tests) a temporary folder stands in; on a cluster each
    executor would write to a disk of its own, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="sluiceway-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nothing has used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def quoted(name: str) -> str:
    """Back-quote a column name, so dots and odd characters stay part of it."""
    return "`" + name.replace("`", "``") + "`"


def quoted_table(name: str) -> str:
    """Back-quote each part of a dotted table name."""
    return ".".join(quoted(part) for part in name.split("."))


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
