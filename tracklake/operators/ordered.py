"""Ordered operators that never need a whole group in one task.

"Newest value before this row" is a window over (group, bucket). Groups larger than an
average shuffle partition are cut into buckets of about equal row counts along the order
column, and the last value of each bucket is handed to the next one as a carry row, so
the result equals the plain window for any data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.operators.lookup import BROADCAST_BYTES, HOT_ROWS, approx_bytes, hot_frame, hot_groups


def _bounds_below(bounds: Column, value: Column, longest: int) -> Column:
    """How many of the sorted bounds are below the value, by binary search."""
    steps = [1 << k for k in reversed(range(max(1, longest.bit_length())))]

    def advance(done: Column, step: Column) -> Column:
        reach = done + step
        inside = (reach <= F.size(bounds)) & (F.try_element_at(bounds, reach) < value)
        return F.when(inside, reach).otherwise(done)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def with_bucket(df: DataFrame, by: list[str], order: str, min_rows: int | None = HOT_ROWS) -> tuple[DataFrame, bool]:
    """Add ``_bucket``, increasing with ``order`` inside each group; 0 for groups of normal size.

    ``min_rows=None`` says that the caller has already seen that no group is large.
    """
    hot = [] if min_rows is None else hot_groups(df, by, min_rows)
    if not hot:
        return df.withColumn("_bucket", F.lit(0)), False
    most = max(h[-1] for h in hot)
    shares = [k / most for k in range(1, most)] or [0.5]
    cuts = (
        df.join(F.broadcast(hot_frame(df, by, hot)), by)
        .groupBy(*by, "_pieces")
        .agg(F.percentile_approx(order, F.array(*[F.lit(s) for s in shares]), F.lit(100_000)).alias("_all"))
        .withColumn(
            "_bounds",
            F.array_sort(
                F.transform(
                    F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1), lambda k: k > 0),
                    lambda k: F.element_at("_all", F.floor(k * F.lit(most) / F.col("_pieces")).cast("int")),
                )
            ),
        )
        .select(*by, "_bounds")
        .collect()  # at most shuffle.partitions rows, two bounds per partition on average
    )
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    kind = df.schema[order].dataType.simpleString()
    bounds = df.sparkSession.createDataFrame(cuts, f"{fields}, _bounds array<{kind}>")
    longest = max(len(r["_bounds"]) for r in cuts)
    placed = df.join(F.broadcast(bounds), by, "left").withColumn(
        "_bucket", F.coalesce(_bounds_below(F.col("_bounds"), F.col(order), longest), F.lit(0))
    )
    return placed.drop("_bounds"), True


def fill_forward(
    df: DataFrame,
    by: list[str],
    order: list[str],
    values: dict[str, Column],
    inclusive: bool = True,
    min_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add, per name, the newest non-null value at or before (or only before) each row.

    Wrap values in a struct where a stored NULL must count as a value.
    """
    placed, split = with_bucket(df, by, order[0], min_rows)
    for name, value in values.items():
        placed = placed.withColumn(f"_in_{name}", value)
    last_row = Window.currentRow if inclusive else -1
    if not split:
        w = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, last_row)
        for name in values:
            placed = placed.withColumn(name, F.last(f"_in_{name}", ignorenulls=True).over(w))
        return placed.drop("_bucket", *[f"_in_{n}" for n in values])
    position = F.struct(*order)
    ends = placed.groupBy(*by, "_bucket").agg(
        *[F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), position)).alias(f"_in_{n}") for n in values]
    )
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *by,
        "_bucket",
        F.lit(0).alias("_real"),
        *[F.last(f"_in_{n}", ignorenulls=True).over(earlier).alias(f"_in_{n}") for n in values],
    )
    rows = placed.withColumn("_real", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    w = (
        Window.partitionBy(*by, "_bucket")
        .orderBy("_real", *order)
        .rowsBetween(Window.unboundedPreceding, last_row)
    )
    for name in values:
        rows = rows.withColumn(name, F.last(f"_in_{name}", ignorenulls=True).over(w))
    return rows.filter("_real = 1").drop("_bucket", "_real", *[f"_in_{n}" for n in values])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    on: str,
    into: str = "match",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """For each left row the newest right row with ``right.on <= left.on`` as a struct, or NULL.

    ``(by, on)`` should be unique on the right; the left side keeps all its rows.
    """
    payload = [c for c in right.columns if c not in by]
    rights = right.select(
        *by, on, F.lit(0).alias("_side"), F.struct(*payload).alias("_match"),
    )
    lefts = left.withColumn("_side", F.lit(1))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    filled = fill_forward(both, by, [on, "_side"], {into: F.col("_match")}, min_rows=min_rows)
    return filled.filter("_side = 1").drop("_side", "_match")


def version_lookup(
    rows: DataFrame,
    versions: DataFrame,
    by: list[str],
    at: str,
    since: str,
    into: str,
    max_bytes: int = BROADCAST_BYTES,
    max_versions: int = 32,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """The version in force at ``at``: the newest one with ``since <= at``.

    A broadcast interval join when the versions are measured to be small and few per
    key (no shuffle of the big side at all); otherwise the skew-safe as-of window.
    """
    sized = versions.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(approx_bytes()).alias("b"))
    size = sized.agg(F.max("n").alias("n"), F.sum("b").alias("b")).first()
    payload = [c for c in versions.columns if c not in by]
    if (size["b"] or 0) <= max_bytes and (size["n"] or 0) <= max_versions:
        w = Window.partitionBy(*by).orderBy(since)
        spans = versions.select(
            *[F.col(c).alias(f"_v_{c}") for c in by],
            F.struct(*payload).alias(into),
            F.col(since).alias("_from"),
            F.coalesce(F.lead(since).over(w), F.lit((1 << 63) - 1)).alias("_to"),
        )
        hit = (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to"))
        for c in by:
            hit = (F.col(c) == F.col(f"_v_{c}")) & hit
        return rows.join(F.broadcast(spans), hit, "left").select(*rows.columns, into)
    if since != at:
        versions = versions.withColumn(at, F.col(since))
    return asof_join(rows, versions.select(*by, at, F.struct(*payload).alias("_p")), by, at, into, min_rows).withColumn(
        into, F.col(f"{into}._p")
    )
