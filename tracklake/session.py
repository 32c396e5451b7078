"""Session defaults and the staging folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Files that a task may have open in a partitioned write.
OPEN_WRITERS = 8
#: Folders made for local sessions that name none, by application.
_FALLBACK: dict[str, str] = {}


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tracklake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _FALLBACK:
        root = _FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="tracklake-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _FALLBACK[context.applicationId]


def staging_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/tracklake/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """Let a task keep a file open for each of a few partitions: rows need not be sorted by partition first, in
    memory that grows with the task's share. With more than ``OPEN_WRITERS`` partitions the rest is sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(OPEN_WRITERS))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later steps then scan columns instead of framing the log files again, and a
    lost executor costs a re-read, not a re-parse.
    """
    path = staging_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        with _open_writers(df.sparkSession):
            writer.partitionBy(*partition_by).parquet(path)
    else:
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``staging_path``; others are refused."""
    if f"/tracklake/{spark.sparkContext.applicationId}/" not in path:
        raise ValueError(f"not a staged table: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``stage``, and the row count taken while writing."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return staged, seen.get["n"]
