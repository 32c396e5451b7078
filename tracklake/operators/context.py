"""Entry definitions, and data records joined to the definition in force (by file order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions.paths import base_type, clean_path, is_array_type, normalise_name
from tracklake.operators.lookup import HOT_ROWS
from tracklake.operators.ordered import fill_forward, version_lookup

ENTRY = ["recording", "entry_id"]


def attach_context(data: DataFrame, control: DataFrame, **limits) -> DataFrame:
    """Data records with ``ctx``: newest earlier Start of their id by ``seq``; NULL for orphans.

    A Finish does not end a definition and timestamps play no part.
    """
    starts = control.filter("kind = 'start'").select(
        *ENTRY,
        F.col("seq").alias("start_seq"),
        clean_path(normalise_name(F.col("entry_name"))).alias("key"),
        "entry_type",
    )
    data = data.select("recording", "seq", "ts", "entry_id", "data")
    return version_lookup(data, starts, ENTRY, "seq", "start_seq", "ctx", **limits)


def keyed(with_context: DataFrame) -> DataFrame:
    entry_type = F.col("ctx.entry_type")
    return with_context.filter("ctx is not null").select(
        "recording",
        "seq",
        "ts",
        "entry_id",
        F.col("ctx.key").alias("key"),
        entry_type.alias("entry_type"),
        base_type(entry_type).alias("base_type"),
        is_array_type(entry_type).alias("is_array"),
        "data",
    )


def orphans(with_context: DataFrame) -> DataFrame:
    """Data records whose id has no earlier Start."""
    return with_context.filter("ctx is null").drop("ctx")


def entry_defs(records: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """One row per Start: the ``seq`` span it covers and the last metadata set in it.

    Every control record adds its part to a definition and one map-side-combined
    aggregation puts the parts together.
    """
    control = records.filter("kind <> 'raw'").select(
        *ENTRY, "seq", "kind", "entry_name", "entry_type", "metadata"
    )
    started = F.when(F.col("kind") == "start", F.col("seq"))
    placed = fill_forward(control, ENTRY, ["seq"], {"_before": started}, inclusive=False, min_rows=min_rows)
    is_start = F.col("kind") == "start"
    note = F.when(F.col("metadata").isNotNull(), F.struct("seq", "metadata"))
    empty = F.lit(None).cast("bigint")
    own = F.struct(
        F.when(is_start, F.col("seq")).otherwise(F.col("_before")).alias("start_seq"),
        empty.alias("end_seq"),
        F.when(F.col("kind") == "finish", F.col("seq")).alias("finish_seq"),
        F.when(is_start, F.struct("entry_name", "entry_type")).alias("names"),
        note.alias("note"),
    )
    closes_previous = F.struct(
        F.col("_before").alias("start_seq"),
        F.when(is_start, F.col("seq")).alias("end_seq"),
        empty.alias("finish_seq"),
        F.when(F.lit(False), F.struct("entry_name", "entry_type")).alias("names"),
        F.when(F.lit(False), F.struct("seq", "metadata")).alias("note"),
    )
    return (
        placed.select(*ENTRY, F.explode(F.array(own, closes_previous)).alias("part"))
        .select(*ENTRY, "part.*")
        .filter("start_seq is not null")
        .groupBy(*ENTRY, "start_seq")
        .agg(
            F.min("end_seq").alias("end_seq"),
            F.min("finish_seq").alias("finish_seq"),
            F.max("names").alias("names"),
            F.max("note").alias("note"),
        )
        .select(
            *ENTRY,
            "start_seq",
            "end_seq",
            "finish_seq",
            clean_path(normalise_name(F.col("names.entry_name"))).alias("key"),
            F.col("names.entry_type").alias("entry_type"),
            F.col("note.metadata").alias("metadata"),
        )
    )
