"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 256 << 20
IN_MEMORY_GROWTH = 4  # bytes of rows for a byte of compressed columns


def pin_session(spark: SparkSession) -> SparkSession:
    """Settings the results depend on: scraped_at is naive UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def _hadoop_path(spark: SparkSession, name: str):
    """The path and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def any_file(spark: SparkSession, folders: str) -> bool:
    """Is there anything in one of the folders?  Stops at the first find; files are not listed."""
    path, fs = _hadoop_path(spark, folders)
    found = fs.globStatus(path) or ()
    return any(f.isFile() or fs.listStatusIterator(f.getPath()).hasNext() for f in found)


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern; none if there is no such folder."""
    path, fs = _hadoop_path(spark, pattern)
    return [f.getPath().toString() for f in fs.globStatus(path) or ()]


def first_bytes(spark: SparkSession, name: str, size: int) -> bytes:
    """At most ``size`` bytes from the beginning of a file."""
    path, fs = _hadoop_path(spark, name)
    stream = fs.open(path)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def delete_folder(spark: SparkSession, name: str) -> None:
    """Delete a folder of this library's own; nothing happens if it is not there."""
    path, fs = _hadoop_path(spark, name)
    fs.delete(path, True)


def create_marker(spark: SparkSession, name: str) -> None:
    """Create an empty file."""
    path, fs = _hadoop_path(spark, name)
    fs.create(path, True).close()


def table_bytes(df: DataFrame) -> int:
    """Size of the files behind ``df`` as the planner knows it, after pruning; no file is opened."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def shuffles_sized_for(spark: SparkSession, pattern: str) -> Iterator[int]:
    """Raise the shuffle partition count to what the files under the path pattern need.

    Adaptive execution merges partitions that turn out small; it cannot make
    more of them, so a count that is too low means spills.
    """
    path, fs = _hadoop_path(spark, pattern)
    size = sum(fs.getContentSummary(found.getPath()).getLength() for found in fs.globStatus(path) or ())
    wanted = size * IN_MEMORY_GROWTH // PARTITION_BYTES
    before = spark.conf.get("spark.sql.shuffle.partitions")
    count = max(int(before), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    try:
        yield count
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tagledger-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/tagledger/{spark.sparkContext.applicationId}"


_scope: ContextVar[list[str] | None] = ContextVar("tagledger_scope", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the scratch folder and read it back.

    Cuts the lineage: what was assigned before (row positions, partition
    numbers) is now data, the same for every later reader and every retry.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let go of the shuffle files of finished jobs.

    What was made from them must be staged itself.  Spark deletes shuffle files once their plans are
    collected on the driver, which without a call can take until long after the job.
    """
    for df in staged:
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            delete_folder(df.sparkSession, folder)
    SparkSession.active()._jvm.System.gc()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside; results must be stored by then."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for name in paths:
            delete_folder(spark, name)
