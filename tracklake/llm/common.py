"""Helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.session import staging_path, unstage

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact(df: DataFrame, *names: str) -> DataFrame:
    """Just the columns ``names`` by their exact spelling, whatever else ``df`` holds.

    Extra columns that differ only in case, or repeat a name, would make a plain
    ``select`` ambiguous; of repeated names the first counts.
    """
    at = [df.columns.index(n) for n in names]
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))).select(*(F.col(f"_{i}").alias(n) for i, n in zip(at, names, strict=True)))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


class Stage:
    """Tables written once to the shared folder and read back; ``drop`` removes one that no later step reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = staging_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            unstage(self.spark, self.paths.pop(name))

    def clear(self) -> None:
        self.drop(*list(self.paths))


def components(spark: SparkSession, edges: DataFrame, label: str, max_rounds: int = 200, stage: Stage | None = None) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): one row (id, component) per node with an edge.

    ``component`` is the smallest id reachable. Large-star and small-star steps take turns
    until the edges are stars; a hub's edges are joined to its minimum, which is
    aggregated map-side first, and never gathered in one group. Null ends are ignored. The
    stars are read from a table of ``stage``.
    """
    stage = stage or Stage(spark, label)
    edges = edges.select("a", "b").where("a <> b")
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges-0")
    state = None
    for turn in range(max_rounds):
        seen = now.agg(F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state or seen["n"] == 0:
            break
        state = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every a > b here: the star of a's smaller neighbours
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS a", "m AS b").where("a <> b")
        after = small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        after = stage(after, f"{label}-edges-{turn + 1}")
        stage.drop(f"{label}-edges-{turn}")
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
