"""Control payloads (records with id 0) decoded with column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.binary import le_unsigned

# Fixed values of the log format: control record kinds by first payload byte.
KINDS = {0: "start", 1: "finish", 2: "set_metadata"}

RECORD_COLUMNS = [
    "recording", "seq", "ts", "kind", "entry_id", "entry_name", "entry_type", "metadata", "data",
]


def _u32_at(at: Column) -> Column:
    """LE u32 at 0-based offset ``at`` of ``data``, NULL where the payload ends before."""
    return F.when(F.octet_length("data") >= at + 4, le_unsigned(F.col("data"), 4, at.cast("int") + F.lit(1)))


def _bytes_at(at: Column, size: Column) -> Column:
    whole = F.octet_length("data") >= at + size
    return F.when(whole, F.substring(F.col("data"), at.cast("int") + F.lit(1), size.cast("int")))


def decode_records(frames: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Frames to records plus an ``issue`` column. After this ``entry_id`` of a control row is its target."""
    control = F.col("entry_id") == 0
    named = F.col("kind") == "start"
    noted = F.col("kind").isin("start", "set_metadata")
    out = (
        frames.withColumn("_code", F.when(control, le_unsigned(F.col("data"), 1)))
        .withColumn(
            "kind",
            F.when(~control, "raw").when(F.col("_code") == 0, "start").when(F.col("_code") == 1, "finish").when(
                F.col("_code") == 2, "set_metadata"
            ),
        )
        .withColumn("_target", F.when(control, _u32_at(F.lit(1))))
        .withColumn("_len1", F.when(noted, _u32_at(F.lit(5))))
        .withColumn("_text1", F.when(noted, _bytes_at(F.lit(9), F.col("_len1"))))
        .withColumn("_at2", F.when(named, 9 + F.col("_len1")))
        .withColumn("_len2", F.when(named, _u32_at(F.col("_at2"))))
        .withColumn("_text2", F.when(named, _bytes_at(F.col("_at2") + 4, F.col("_len2"))))
        .withColumn("_at3", F.when(named, F.col("_at2") + 4 + F.col("_len2")))
        .withColumn("_len3", F.when(named, _u32_at(F.col("_at3"))))
        .withColumn("_text3", F.when(named, _bytes_at(F.col("_at3") + 4, F.col("_len3"))))
    )
    short = (
        F.col("_target").isNull()
        | (noted & F.col("_text1").isNull())
        | (named & (F.col("_text2").isNull() | F.col("_text3").isNull()))
    )
    bad_text = F.lit(False)
    for name in ("_text1", "_text2", "_text3"):
        bad_text = bad_text | ~F.coalesce(F.is_valid_utf8(F.col(name).cast("string")), F.lit(True))
    issue = F.coalesce(
        F.col("issue"),
        F.when(control & F.col("_target").isNull(), "truncated control record")
        .when(control & F.col("kind").isNull(), "unknown control record")
        .when(control & short, "truncated control record")
        .when(control & bad_text, "invalid string"),
    )
    out = out.withColumn("issue", issue)
    if mode.upper() == "FAILFAST":
        stop = F.raise_error(F.concat_ws(" ", F.col("recording"), F.col("seq").cast("string"), F.col("issue")))
        out = out.withColumn("issue", F.when(F.col("issue").isNotNull(), stop.cast("string")))
    text = {n: F.col(n).cast("string") for n in ("_text1", "_text2", "_text3")}
    fine = F.col("issue").isNull()
    return out.select(
        "recording",
        "seq",
        "ts",
        "kind",
        F.when(control & fine, F.col("_target")).otherwise(F.col("entry_id")).alias("entry_id"),
        F.when(fine & named, text["_text1"]).alias("entry_name"),
        F.when(fine & named, text["_text2"]).alias("entry_type"),
        F.when(fine & named, text["_text3"]).when(fine & noted, text["_text1"]).alias("metadata"),
        F.when(~control | ~fine, F.col("data")).alias("data"),
        "issue",
        "head",
    )
