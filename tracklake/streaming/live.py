"""Log files that keep arriving: every micro-batch of files goes through the batch plan.

State never crosses files, so there is no watermark and no state store. Tables are
replaced per recording and changes per batch, so a replayed batch leaves the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracklake.plans.ingest import Ingest
from tracklake.sources.logfiles import FILE_SCHEMA, WHOLE_FILE_BYTES, with_recording
from tracklake.sources.tables import write_tables


def watch(spark: SparkSession, path: str, glob: str = "*.wpilog", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def ingest_stream(
    spark: SparkSession, path: str, out: str, checkpoint: str, glob: str = "*.wpilog", **options
) -> StreamingQuery:
    """Process the files that are there and stop (``availableNow``); run again for new ones."""

    def run(batch: DataFrame, batch_id: int) -> None:
        files = with_recording(batch)
        small = files.filter(F.col("length") <= WHOLE_FILE_BYTES).select("recording", "path", "content")
        large = files.filter(F.col("length") > WHOLE_FILE_BYTES).select("recording", "path", "length")
        write_tables(Ingest(small, large, **options), out, batch_id)

    return (
        watch(spark, path, glob)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
