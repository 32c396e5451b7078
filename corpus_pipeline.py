"""A training corpus from ``documents``: language, near copies, repeated passages, benchmark leaks, mix.

Each stage works on what the one before kept; ``run`` writes every stage's output to the shared
folder and reads it back, as the driver of ``STAGES`` does. Rows with a null doc_id pass the stages that
match documents with each other; leaks are found in them too. Columns beside those of ``documents`` pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm import decontamination, language, minhash, mixing, substrings
from tracklake.llm.common import Stage, table

#: Ids that a broadcast may hold: 16 MB at most.
BROADCAST_IDS = 1_000_000
#: Rows and bytes of a batch that goes to a Python worker; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Hold batches between the executor and its Python workers to ``BATCH_BYTES``, unless the session asks for less still.

    Both sides keep copies of a batch, outside the heap, for each running task.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
        spark.conf.set(name, str(min(now, most) if now > 0 else most))


def _marked(docs: DataFrame) -> DataFrame:
    """``docs``, its columns named by their places, with ``id``, ``text`` and ``mark``, a hash of the text."""
    at = docs.columns.index
    text = F.col(f"_{at('text')}")
    mark = F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    return docs.toDF(*(f"_{i}" for i in range(len(docs.columns)))).withColumns({"id": F.col(f"_{at('doc_id')}"), "text": text, "mark": mark})


def _plain(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from those of ``_marked``."""
    return marked.select(*(f"_{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)


def _without(spark: SparkSession, marked: DataFrame, found: DataFrame, by: str, label: str) -> DataFrame:
    """``marked`` without the rows whose ``by`` is in ``found``; texts are shuffled only if these are too many to broadcast."""
    found = Stage(spark, label)(found.select(by).distinct(), "dropped")
    return marked.join(F.broadcast(found) if found.count() <= BROADCAST_IDS else found, by, "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, and those whose best score is under 1.2 times chance (1 / number of languages), or under a half if that is less."""
    _small_batches(spark)
    return language.accept(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id, and one row of it.

    Different texts with the same doc_id are different documents.
    """
    _small_batches(spark)
    tables = Stage(spark, "near-copies-work")
    marked = _marked(docs)
    texts = marked.where("id IS NOT NULL").select("id", "mark").distinct()
    if texts.groupBy("id").count().where("count > 1").isEmpty():
        marked = marked.withColumn("row", F.col("id").cast("long"))
    else:  # numbers in the order of the ids
        numbers = tables(texts.orderBy(F.col("id").cast("long"), "mark").withColumn("row", F.monotonically_increasing_id()), "numbers")
        marked = Stage(spark, "near-copies")(marked.join(numbers, ["id", "mark"], "left"), "numbered")
    found = minhash.near_duplicates(spark, marked.select(F.col("row").alias("doc_id"), "text"), stage=tables)
    found = Stage(spark, "near-copies")(found.withColumnRenamed("doc_id", "row"), "groups")
    tables.clear()
    left = _without(spark, marked, found.where("component_id IS NOT NULL AND NOT kept"), "row", "near-copies")
    twice = found.where("kept").groupBy("row").count().where("count > 1").select("row")
    if twice.isEmpty():
        return _plain(left, docs)
    once = left.join(twice, "row", "left_semi").dropDuplicates(["row"])
    return _plain(left.join(twice, "row", "left_anti").unionByName(once), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document, or the same one earlier, holds are cut out; n_chars follows."""
    _small_batches(spark)
    cut = substrings.without_repeats(spark, docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go, each by its own text, also without a doc_id."""
    marked = _marked(docs)
    leaks = decontamination.all_leaks(spark, marked.select(F.col("mark").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _plain(_without(spark, marked, leaks.withColumnRenamed("doc_id", "mark"), "mark", "leaks"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, turn, position, words: a row per pass over a document, in training order."""
    return mixing.in_training_order(mixing.mix(spark, docs))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("leaks", drop_leaks),
    ("mix", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = Stage(spark, "pipeline")(docs, name)
    return docs
