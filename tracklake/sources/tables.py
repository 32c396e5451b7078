"""Writing result tables, replaced per recording so that a rerun changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.operators.entries import change_set

#: The tables of an ingest that are written.
TABLES = (
    "recordings", "records", "entry_defs", "schema_fields", "struct_layout", "entries", "entity_rows", "quarantine",
    "unresolved",
)
#: Columns that output files are sorted by, so that their statistics prune.
SORTED_BY = ("key", "entity", "struct_name", "ts", "seq")


def _fs(df: DataFrame, path: str):
    context = df.sparkSession.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def write_table(df: DataFrame, path: str, recordings: DataFrame | None = None) -> None:
    """Parquet partitioned by recording; the recordings in ``df`` are replaced.

    ``recordings`` are those that were read: the old rows of one that has none now are
    removed as well. The rebalance hint lets adaptive execution join small output pieces
    and split a recording that is much larger than the rest.
    """
    order = [c for c in SORTED_BY if c in df.columns]
    (
        df.hint("rebalance", "recording")
        .sortWithinPartitions("recording", *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("recording")
        .parquet(path)
    )
    if recordings is not None:
        remove_recordings(df, path, recordings)


def remove_recordings(df: DataFrame, path: str, recordings: DataFrame) -> None:
    """Remove the partitions of ``recordings`` that have no row in ``df``; as many as files were read at most."""
    fs, root = _fs(df, path)
    if not _has_partitions(fs, root):
        return
    empty = recordings.select("recording").distinct().join(df.select("recording").distinct(), "recording", "left_anti")
    jvm = df.sparkSession.sparkContext._jvm
    named, of = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString, jvm.org.apache.hadoop.fs.Path
    for row in empty.toLocalIterator():
        at = of(root, named("recording", row["recording"]))
        if fs.exists(at):
            fs.delete(at, True)


def _has_partitions(fs, root) -> bool:
    """Whether any recording is stored below ``root``; reads on to the first folder only."""
    if not fs.exists(root):
        return False
    found = fs.listStatusIterator(root)
    while found.hasNext():
        if found.next().isDirectory():
            return True
    return False


def write_changes(changes: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch to the change feed; writing the same batch again replaces it."""
    fs, at = _fs(changes, f"{path}/batch_id={batch_id}")
    if fs.exists(at):
        fs.delete(at, True)
    changes.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_tables(ingest, out: str, batch_id: int = 0) -> None:
    """All tables of an ``Ingest`` below ``out``, and the changes of the batch."""
    found = ingest.found_recordings
    stored = ingest.stored_entries
    for name in TABLES:
        write_table(stored if name == "entries" else getattr(ingest, name), f"{out}/{name}", found)
    write_changes(change_set(stored), f"{out}/changes", batch_id)
