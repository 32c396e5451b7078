"""Log files as rows: listing, magic filter, header decode, recording table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions.binary import le_unsigned

# Fixed values of the log format.
MAGIC = b"WPILOG"
VERSION = 0x0100

# Properties that every recording carries for the viewer; not part of the format.
STORE_SOURCE = "WpiLog"
RECORDING_NAME = "WpiLog"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Files above this are framed by byte range (see ranges.py), smaller ones whole.
WHOLE_FILE_BYTES = 256 << 20


def list_files(spark: SparkSession, path: str, glob: str = "*.wpilog") -> DataFrame:
    """Paths and sizes only; Spark's column pruning skips the contents."""
    return _reader(spark, path, glob).select("path", "length")


def read_files(
    spark: SparkSession, path: str, glob: str = "*.wpilog", max_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """``(path, content)`` of the files up to ``max_bytes``, found recursively.

    ``length`` is a pushed-down filter of the source, so larger files are not opened here.
    """
    return _reader(spark, path, glob).filter(F.col("length") <= max_bytes).select("path", "content")


def _reader(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def recording_id(path: Column) -> Column:
    """File name without its extension plus a hash of the whole path: short and unique."""
    stem = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    return F.concat_ws("-", stem, F.substring(F.md5(path), 1, 16))


def with_recording(files: DataFrame, recording: Column | None = None) -> DataFrame:
    return files.withColumn("recording", recording_id(F.col("path")) if recording is None else recording)


def is_log(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, len(MAGIC)) == F.lit(MAGIC), F.lit(False))


def with_header(files: DataFrame) -> DataFrame:
    """Keep log files and add ``version``, ``extra_header``, ``body_at`` and ``header_issue``."""
    content = F.col("content")
    size = F.octet_length(content)
    extra_len = F.when(size >= 12, le_unsigned(content, 4, 9))
    return (
        files.filter(is_log(content))
        .withColumn("version", F.when(size >= 8, le_unsigned(content, 2, 7)).cast("int"))
        .withColumn("body_at", 12 + extra_len)
        .withColumn("_extra", F.when(F.col("body_at") <= size, F.expr("substring(content, 13, int(body_at - 12))")))
        .withColumn(
            "header_issue",
            F.when(F.col("version").isNull(), "truncated header")
            .when(F.col("version") != VERSION, "unsupported version")
            .when(F.col("_extra").isNull(), "truncated header")
            .when(~F.is_valid_utf8(F.col("_extra").cast("string")), "invalid string"),
        )
        .withColumn("extra_header", F.when(F.col("header_issue").isNull(), F.col("_extra").cast("string")))
        .drop("_extra")
    )


def recordings(headers: DataFrame, application_id: str | None = None) -> DataFrame:
    """One row per readable log file, from rows (recording, head)."""
    app = F.concat(F.lit("app-"), F.substring(F.md5("head.path"), 1, 16))
    return headers.filter("head.issue is null").select(
        "recording",
        "head.path",
        "head.version",
        "head.extra_header",
        "head.n_bytes",
        F.lit(STORE_SOURCE).alias("store_source"),
        (F.lit(application_id) if application_id else app).alias("application_id"),
        F.lit(RECORDING_NAME).alias("name"),
    )


def header_problems(headers: DataFrame) -> DataFrame:
    """``(recording, reason)`` of log files whose header cannot be read."""
    return headers.filter("head.issue is not null").select("recording", F.col("head.issue").alias("reason"))
