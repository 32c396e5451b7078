"""Joins against a side that is usually small: size checked, salted beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HOT_ROWS = 1_000_000


def approx_bytes() -> F.Column:
    """Width of a row as text, an upper-side stand-in for its in-memory size."""
    return F.length(F.to_json(F.struct("*"))).cast("bigint")


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    total = df.select(approx_bytes().alias("b")).agg(F.sum("b").alias("b")).first()["b"]
    return (total or 0) <= max_bytes


def hot_groups(df: DataFrame, by: list[str], min_rows: int = HOT_ROWS) -> list:
    """Groups that need splitting, with the number of pieces for each.

    At most ``spark.sql.shuffle.partitions`` groups can be larger than an average
    shuffle partition, so that many of the largest are enough and the list stays small
    whatever the data size. One column-pruned, map-side-combined pass.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    top = counts.filter(F.col("rows") > min_rows).orderBy(F.desc("rows")).limit(parts).collect()
    if not top:
        return []
    piece = max(min_rows, sum(r["rows"] for r in top) // parts)
    return [(*[r[c] for c in by], -(-r["rows"] // piece)) for r in top]


def hot_frame(df: DataFrame, by: list[str], hot: list) -> DataFrame:
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    return df.sparkSession.createDataFrame(hot, f"{fields}, _pieces bigint")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join ``big`` with ``small``: broadcast when ``small`` is measured to fit,
    else a shuffle join in which the hot keys of ``big`` are salted."""
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    hot = hot_groups(big, on, min_rows)
    if not hot:
        return big.join(small, on, how)
    pieces = F.broadcast(hot_frame(big, on, hot))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_pieces"))
    left = big.join(pieces, on, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_pieces")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    right = small.join(pieces, on, "left").withColumn("_salt", F.explode(copies)).drop("_pieces")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
