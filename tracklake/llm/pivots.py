"""Exact integer k-means with a LAESA pivot table (op12).

Each vector's distances to a few fixed pivots are computed once and stored beside it. In a round a
centroid's distances to the pivots give, by the triangle inequality, a lower bound of its
distance to every vector; only centroids whose bound doesn't exceed the best exact distance found so far get an exact integer
distance. Tasks return sums per cluster, so a round shuffles one row per task and cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table

PARTS, SCALE, CLUSTERS, ROUNDS, PIVOTS = 64, 64, 16, 3, 16
#: With components up to this size, squared distances and their comparisons fit 62 bits.
LARGEST = 1 << 27
ROWS = 8192


def _usable(vector: Column, parts: int, scale: int) -> Column:
    number = vector.cast("array<double>")
    fine = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < LARGEST))
    return F.coalesce((F.size(vector) == parts) & fine, F.lit(False))


def kept_vectors(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of the vectors with ``parts`` components, all finite."""
    rows = exact(vectors, "vec_id", "embedding").where(_usable(F.col("embedding"), parts, scale))
    return rows.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The vectors with the ``k`` smallest hashes of their ids; of a repeated id, the smaller vectors first; null ids last."""
    rows = kept.select(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "v")
    return np.array([r["v"] for r in rows.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()], np.int64)


def _matrix(column: pa.ListArray, parts: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts)


def _squares(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squares(v, p) for p in pivots], 1).astype(np.float64))


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid per vector (the smaller of equally near ones), squared distance, exact distances computed.

    Centroids are visited per vector from the least lower bound up, and a vector is done when its next bound lies above its best
    distance. The bound's rounding is allowed for, so no centroid that could win or tie is left out.
    """
    n, k = len(v), len(centroids)
    of_centroids = pivot_distances(centroids, pivots)
    bound = np.zeros((n, k))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_centroids[None, :, p]), out=bound)
    bound = np.maximum(bound * (1 - 1e-9) - 1e-6, 0) ** 2 * (1 - 1e-9)
    order = np.argsort(bound, axis=1, kind="stable")
    best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    alive, computed = np.arange(n), 0
    for turn in range(k):
        c = order[alive, turn]
        open_ = bound[alive, c] <= best[alive].astype(np.float64) * (1 + 1e-9)
        alive, c = alive[open_], c[open_]
        if not len(alive):
            break
        computed += len(alive)
        d = _squares(v[alive], centroids[c])
        wins = (d < best[alive]) | ((d == best[alive]) & (c < number[alive]))
        best[alive[wins]], number[alive[wins]] = d[wins], c[wins]
    return number.astype(np.int32), best, computed


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                v = _matrix(part.column(1), centroids.shape[1])
                to_pivots = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
                yield part, v, *nearest(v, to_pivots, centroids, pivots)

    return run


def _round(spark: SparkSession, stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: componentwise exact floor of the mean; empty ones stay."""
    k, parts = centroids.shape
    assign = _assigned(centroids, pivots)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, parts), np.int64)
        for _, v, number, _, _ in assign(batches):
            order = np.argsort(number, kind="stable")
            found, at = np.unique(number[order], return_index=True)
            total[found] += np.add.reduceat(v[order], at, axis=0)
            count += np.bincount(number, minlength=k)
        used = np.flatnonzero(count)
        flat = total[used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * parts, pa.int32()), pa.array(flat.ravel()))],
            names=["cluster", "n", "total"],
        )

    rows = stored.mapInArrow(sums, "cluster int, n long, total array<long>")
    wide = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(parts)]
    after = centroids.copy()
    for r in rows.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():  # a row per cluster
        after[r["cluster"]] = [int(r[f"t{i}"]) // r["n"] for i in range(parts)]
    return after


def cluster(
    spark: SparkSession, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, parts: int = PARTS, scale: int = SCALE, pivots: int = PIVOTS
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per kept row of ``vectors`` (vec_id, embedding).

    Vectors of another length, null ones, and those with a null or non-finite component are left
    out; so are those with a component of 2^21 or more, whose squared distances could pass a long. The first ``pivots`` initial centroids serve
    as pivots throughout. Fewer than ``k`` vectors make as many centroids; none make an empty
    result. Rows that repeat an id are vectors of their own. Other columns are ignored.
    """
    tables = Stage(spark, "pivots")
    kept = tables(kept_vectors(vectors, parts, scale), "vectors")
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(kept, k)
    if not len(centroids):
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    fixed = centroids[:pivots].copy()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = pivot_distances(_matrix(batch.column(1), parts), fixed)
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * len(fixed), pa.int32()), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=["vec_id", "v", "to_pivots"])

    stored = tables(kept.mapInArrow(measured, f"vec_id {kind}, v array<int>, to_pivots array<double>"), "table")
    tables.drop("vectors")
    for _ in range(rounds):
        centroids = _round(spark, stored, centroids, fixed)
    assign = _assigned(centroids, fixed)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, best, _ in assign(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(best)], names=["vec_id", "cluster", "distance"])

    rows = tables(stored.mapInArrow(final, f"vec_id {kind}, cluster int, distance long"), "assigned")
    tables.drop("table")
    sums = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row per cluster
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    long = lambda x: F.lit(str(x)).try_cast("long")
    per = F.array(*(F.struct(long(sums.get(i, 0)).alias("s"), F.lit(h).alias("h")) for i, h in enumerate(hashes)))
    mine = F.element_at(per, F.col("cluster") + 1)
    return rows.select(
        "vec_id", "cluster", "distance", mine["s"].alias("cluster_inertia"), long(sum(sums.values())).alias("inertia"), mine["h"].alias("centroid_sha256")
    )


def op12_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark, table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """The same by brute force: every vector against every centroid, component by component."""
    steps = [
        "kept AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0)",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS m FROM kept QUALIFY c < 16)",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"a{i} AS (SELECT r, vec_id, c, m, v, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{i} "
            "QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"
        )
        if i < ROUNDS:
            steps += [
                f"e{i} AS (SELECT c, i, sum(v[i]::HUGEINT) AS s, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY c, i)",
                f"f{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM e{i} GROUP BY c)",
                f"c{i + 1} AS (SELECT c, coalesce(f{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN f{i} USING (c))",
            ]
    last = f"a{ROUNDS}"
    return (
        "WITH " + ", ".join(steps) + f" SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, "
        f"(sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM {last}"
    )


ORACLE = _oracle()
