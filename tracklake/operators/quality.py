"""Quarantine: rows that cannot be used, with the stage and the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.binary import literal_map

QUARANTINE = {
    "recording": "string", "seq": "bigint", "ts": "bigint", "key": "string", "entry_type": "string",
    "n_bytes": "int", "stage": "string", "reason": "string",
}

# Bytes per element of the fixed-width entry types.
ELEMENT_BYTES = {"boolean": 1, "int64": 8, "float": 4, "double": 8}
SCALAR_TYPES = ["raw", "string", *ELEMENT_BYTES]


def quarantine(df: DataFrame, stage: str, reason: Column | None = None) -> DataFrame:
    """Bring any frame to the quarantine columns; missing ones become NULL."""
    cols = []
    for name, kind in QUARANTINE.items():
        if name == "stage":
            value = F.lit(stage)
        elif name == "reason" and reason is not None:
            value = reason
        elif name == "n_bytes" and "data" in df.columns:
            value = F.octet_length("data")
        elif name in df.columns:
            value = F.col(name)
        else:
            value = F.lit(None)
        cols.append(value.cast(kind).alias(name))
    return df.select(*cols)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def element_bytes() -> Column:
    return F.try_element_at(literal_map(ELEMENT_BYTES), F.col("base_type"))


def value_issue() -> Column:
    """Why a keyed row of a plain (non-struct) type cannot be decoded; NULL if it can."""
    base, size, width = F.col("base_type"), F.octet_length("data"), element_bytes()
    short = F.concat(F.lit("too few bytes for a "), base)
    return (
        F.when(base == "json", "json values are not decoded")
        .when(F.col("is_array") & base.isin("raw", "string"), F.concat(base, F.lit(" has no array form")))
        .when(F.col("is_array") & (F.pmod(size, width) != 0), "trailing partial element")
        .when(~F.col("is_array") & base.isin("int64", "float", "double") & (size < width), short)
        .when(~base.isin(*SCALAR_TYPES), "no such type")
    )


def is_struct() -> Column:
    return F.startswith(F.col("base_type"), F.lit("struct:"))


def is_schema() -> Column:
    return F.col("base_type") == "structschema"


def value_problems(keyed: DataFrame) -> DataFrame:
    plain = keyed.filter(~is_struct() & ~is_schema()).withColumn("reason", value_issue())
    return quarantine(plain.filter("reason is not null"), "value")


def summary(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("entry_type", "stage", "reason").agg(F.count(F.lit(1)).alias("n"))
