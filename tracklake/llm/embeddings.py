"""Near-duplicate vectors by a forest of random-projection trees.

Every level of every tree has one random direction; a node splits at the median of its sample
vectors on it (at the level's median where too few reach the node). A vector within ``SPILL`` of the split goes to both
sides, so close pairs near a split meet anyway. The directions and medians are fitted on
a bounded sample; every vector is put into the leaves of every tree, and all vectors of a leaf with equal
labels are compared in double precision.

A pair that meets in several leaves counts in the first one only: each vector carries the list of
its leaves. So the numbers of links add up without a row per pair. Leaves of more than ``BLOCK``
vectors are compared as pairs of blocks. The ``LENGTHS`` most frequent vector lengths have a forest; the vectors of any
other length are all in one leaf, which compares each with each. Equal vectors of a label are one vector with a weight.

Vectors that are null, empty, zero or hold null or non-finite parts, and null labels, link with nothing;
vectors of different lengths aren't compared; rows with a null vec_id have no links and a null component;
a repeated row counts once as a neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, components, exact, table

TREES = 6
LEAF = 256
SPILL = 0.0125
SAMPLE = 20_000
BLOCK = 2048
THRESHOLD = 0.98
#: Vector lengths that have a forest.
LENGTHS = 1000
#: Sample vectors a node needs for a median of its own.
LEAST_SAMPLE = 16


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Forest:
    """Splits of one vector length: ``splits[tree][level]`` holds a median per node."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 5):
        rng = np.random.default_rng([seed, sample.shape[1]])
        self.depth = depth
        ways = rng.standard_normal((trees, depth, sample.shape[1]))
        self.ways = ways / np.sqrt((ways * ways).sum(axis=2, keepdims=True))
        self.splits, self.middles = [], np.zeros((trees, depth))
        for t in range(trees):
            node, levels = np.zeros(len(sample), np.int64), []
            for level in range(depth):
                on = sample @ self.ways[t, level]
                self.middles[t, level] = np.median(on) if len(on) else 0.0
                if (1 << level) * LEAST_SAMPLE > len(sample):
                    node = node * 2 + (on > self.middles[t, level])
                    continue
                split = np.full(1 << level, self.middles[t, level])
                order = np.argsort(node, kind="stable")
                heads = np.searchsorted(node[order], np.arange((1 << level) + 1))
                for n in np.flatnonzero(np.diff(heads) >= LEAST_SAMPLE):
                    split[n] = np.median(on[order[heads[n] : heads[n + 1]]])
                levels.append(split)
                node = node * 2 + (on > split[node])
            self.splits.append(levels)

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf of every row, by row; a leaf's number holds its tree."""
        rows, found = [], []
        for t, levels in enumerate(self.splits):
            row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
            for level in range(self.depth):
                on = (vectors @ self.ways[t, level])[row]
                side = on - (levels[level][node] if level < len(levels) else self.middles[t, level])
                left, right = side <= SPILL, side > -SPILL
                row, node = np.concatenate((row[left], row[right])), np.concatenate((node[left] * 2, node[right] * 2 + 1))
            rows.append(row)
            found.append(node | (t << 56))
        row, leaf = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]


def _planter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            rows["n"] = rows["embedding"].map(len)
            for n, some in rows.groupby("n"):
                vectors = _unit(np.stack(some["embedding"].to_list()).astype(np.float64))
                alone = np.arange(len(some)), np.zeros(len(some), np.int64)
                row, leaf = shared.value[n].leaves(vectors) if n in shared.value else alone
                heads = np.searchsorted(row, np.arange(len(some) + 1))
                own = [leaf[a:b].tobytes() for a, b in zip(heads, heads[1:])]
                out = some[["rep", "label", "weight"]].assign(vector=[v.tobytes() for v in vectors], leaves=own).iloc[row].assign(n=n, leaf=leaf)
                for at in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_pandas(out.iloc[at : at + 10_000][["rep", "label", "weight", "n", "leaf", "vector", "leaves"]], preserve_index=False)

    return run


def _compare(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable").reset_index(drop=True)
        x = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(len(rows), -1)
        leaf, one, two = rows["leaf"].iat[0], rows["one"].iat[0], rows["two"].iat[0]
        block = rows["block"].to_numpy()
        link = x @ x.T >= threshold
        np.fill_diagonal(link, False)
        if one != two:
            link &= block[:, None] != block[None]
        lists = [np.frombuffer(b, np.int64) for b in rows["leaves"]]
        owner = np.repeat(np.arange(len(rows)), [len(a) for a in lists])
        held = np.concatenate(lists)
        earlier = held < leaf
        _, number = np.unique(held[earlier], return_inverse=True)
        if len(number) and link.any():
            meet = np.zeros((len(rows), number.max() + 1), np.float32)
            meet[owner[earlier], number] = 1
            met = np.zeros_like(link)
            for at in range(0, meet.shape[1], 1024):
                met |= meet[:, at : at + 1024] @ meet[:, at : at + 1024].T > 0
            link &= ~met
        weight, rep = rows["weight"].to_numpy(), rows["rep"].to_numpy()
        links = link @ weight
        root = np.arange(len(rows))
        while True:  # least row number reached, two links further each time
            least = np.where(link, root[None], len(rows)).min(axis=1, initial=len(rows))
            after = np.minimum(root, least)
            after = after[after]
            if (after == root).all():
                break
            root = after
        some = links > 0
        return pd.DataFrame({"rep": rep[some], "links": links[some], "head": rep[root[some]]})

    return run


def link_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    stage = Stage(spark, "forest")
    rows = exact(vectors, "vec_id", "embedding", "label").withColumn("embedding", F.col("embedding").cast("array<double>"))
    sound = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("able", F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & sound, F.lit(False)))
    marks = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    marked = rows.select("*", *marks)
    key = ["label", "h1", "h2"]
    classes = marked.where("able").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("weight"), F.first("embedding").alias("embedding"))
    classes = stage(classes, "classes")
    sizes = {r["n"]: r["count"] for r in classes.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(LENGTHS).collect()}
    total = sum(sizes.values())
    pick = F.pmod(F.xxhash64("h1", F.lit("sample")), F.lit(1 << 20)) < math.ceil(min(1.0, sample / max(total, 1)) * (1 << 20))
    drawn = classes.where(pick & F.size("embedding").isin(list(sizes))).select("embedding").limit(sample).collect()
    forests = {}
    for n, held in sizes.items():
        some = np.array([r["embedding"] for r in drawn if len(r["embedding"]) == n], np.float64).reshape(-1, n)
        forests[n] = Forest(_unit(some), max(0, math.ceil(math.log2(held / LEAF))), trees)
    shared = spark.sparkContext.broadcast(forests)
    kind = rows.schema["label"].dataType.simpleString()
    planted = classes.select("rep", "label", "weight", "embedding").mapInArrow(_planter(shared), f"rep long, label {kind}, weight long, n long, leaf long, vector binary, leaves binary")
    planted = stage(planted, "planted")
    meets = ["label", "n", "leaf"]
    counts = planted.groupBy(*meets).agg(F.count("rep").alias("held")).where("held > 1")
    blocks = F.ceil(F.col("held") / block).cast("int")
    dealt = planted.join(counts, meets).withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.least("block", b).alias("one"), F.greatest("block", b).alias("two")))
    dealt = dealt.withColumn("meeting", F.explode(others)).select(*meets, "rep", "weight", "vector", "leaves", "block", "meeting.one", "meeting.two")
    found = dealt.groupBy(*meets, "one", "two").applyInPandas(_compare(threshold), "rep long, links long, head long")
    found = stage(found, "found")
    joined = components(spark, found.select(F.col("rep").alias("a"), F.col("head").alias("b")), "forest").withColumnRenamed("id", "rep")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_class = classes.drop("embedding").join(links, "rep", "left").join(joined, "rep", "left")
    per_class = per_class.select(*key, F.lit(True).alias("able"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = marked.select("vec_id", "able", *key).join(per_class, [*key, "able"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark, table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL),
u AS (
  SELECT vec_id, label, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS norm FROM v
  WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.98),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a),
r(id, c) AS (SELECT a, a FROM p UNION SELECT r.id, p.b FROM r JOIN p ON p.a = r.c),
c AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, e.vec_id) AS component_id, coalesce(c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.id = e.vec_id
"""
