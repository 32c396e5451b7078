"""Records that may be written twice, found where they are read, so that only suspects are shuffled.

A unit is up to ``UNIT_ROWS`` rows that a task reads in a row. Two rows of one (key, ts) are either in one
unit, which sees their equal hashes, or in two units, whose spans of time of this key then overlap. So a
unit yields the hashes it holds twice and, per key, its first and last ts; spans are compared per
key. Logs are written about in order of time: their units' spans touch at most at their ends, and nothing
else of a record leaves its task. Where spans overlap (files out of order) the overlap is suspect as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tracklake.operators.lookup import HOT_ROWS, lookup_join
from tracklake.session import stage, stage_counted

#: Rows of a unit: 12 MB of hashes and times in a task, and some copies of them.
UNIT_ROWS = 1 << 19
_FOUND = pa.schema([("group", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("twice", pa.int64())])


def _unit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The spans of the unit's groups, then a row per hash that it holds more than once."""
    group, at, write = (rows[i].to_numpy() for i in range(3))
    order = np.argsort(group, kind="stable")
    group, at = group[order], at[order]
    begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    spans = [group[begins], np.minimum.reduceat(at, begins), np.maximum.reduceat(at, begins)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, spans), pa.nulls(len(begins), pa.int64())], schema=_FOUND)
    write = np.sort(write)
    twice = np.unique(write[1:][write[1:] == write[:-1]])
    yield pa.RecordBatch.from_arrays([*[pa.nulls(len(twice), pa.int64())] * 3, pa.array(twice)], schema=_FOUND)


def _units(unit_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= unit_rows:
                yield from _unit(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from _unit(pa.Table.from_batches(held))

    return run


def suspects(rows: DataFrame, by: list[str], on: str, unit_rows: int = UNIT_ROWS, min_rows: int = HOT_ROWS) -> DataFrame | None:
    """(*by, on) of each row that may share it with another row: those that do, and few more; None if there are none.

    Nulls count as equal values. A NULL ``on`` is taken for the least number, so it may add suspects but loses none.
    """
    least = -(1 << 63)
    spotted = rows.select(*by, on).withColumns(
        {"_group": F.xxhash64(*by), "_at": F.coalesce(F.col(on).cast("bigint"), F.lit(least)), "_write": F.xxhash64(*by, on)}
    )
    seen = spotted.select("_group", "_at", "_write").mapInArrow(_units(unit_rows), "group bigint, first bigint, last bigint, twice bigint")
    counted = Observation()
    seen = stage(seen.observe(counted, F.count("twice").alias("n")), "units")
    before = Window.partitionBy("group").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = seen.filter("twice is null").withColumn("reach", F.max("last").over(before)).filter("first <= reach")
    shared = spans.groupBy(F.col("group").alias("_group")).agg(F.min("first").alias("_first"), F.max(F.least("last", "reach")).alias("_last"))
    shared, n_shared = stage_counted(shared, "shared-spans")
    marks = []
    if n_shared:
        spotted = lookup_join(spotted, shared, ["_group"], "left", min_rows=min_rows)
        marks.append(F.coalesce(F.col("_at").between(F.col("_first"), F.col("_last")), F.lit(False)))
    if counted.get["n"]:
        twice = stage(seen.filter("twice is not null").select(F.col("twice").alias("_write")).distinct(), "repeated-hashes")
        spotted = lookup_join(spotted, twice.withColumn("_twice", F.lit(True)), ["_write"], "left", min_rows=min_rows)
        marks.append(F.coalesce("_twice", F.lit(False)))
    return spotted.filter(reduce(or_, marks)).select(*by, on) if marks else None


def repeated(rows: DataFrame, by: list[str], on: str, unit_rows: int = UNIT_ROWS, min_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """The distinct (*by, on) that more than one row holds, and their number."""
    left = suspects(rows, by, on, unit_rows, min_rows)
    if left is None:
        return rows.select(*by, on).limit(0), 0
    return stage_counted(left.groupBy(*by, on).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "repeated-writes")
