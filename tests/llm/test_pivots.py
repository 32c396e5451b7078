"""Clusters from the pivot table against brute force in plain integers."""

import hashlib
import math
import random

import duckdb
import numpy as np

from tracklake.llm import pivots

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, V string, v int"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, n, d) for i, v in kept for d, n in [near(v)]]
    total = {n: sum(d for _, m, d in out if m == n) for _, n, _ in out}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, total[n], sum(total.values()), sha[n]) for i, n, d in out), key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 0, 1, "x", 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in pivots.cluster(spark, frame).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_clusters_are_those_of_brute_force(spark):
    rng = random.Random(2)
    centre = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centre)]) for i in range(400)]
    rows += [(1000 + i, list(centre[0])) for i in range(200)]  # ties and a hot point
    rows += [(7, list(centre[1])), (7, list(centre[1])), (None, list(centre[2])), (2000, [20000.0] * 64), (2001, [-1e6] * 64)]
    rows += [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [math.nan] * 64), (3004, [math.inf] + [0.0] * 63), (3005, [None] + [0.0] * 63), (3006, [0.0] * 64)]
    assert run(spark, rows) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert [r[0] for r in run(spark, [*rows, (9, [1e300] * 64)])] == [0, 1, 2]  # beyond exact longs: left out


def test_pivots_spare_distances_and_never_change_them():
    rng = np.random.default_rng(5)
    centre = rng.integers(-500, 500, (16, 64))
    v = centre[rng.integers(0, 16, 3000)] + rng.integers(-30, 30, (3000, 64))
    number, best, computed = pivots.nearest(v, pivots.pivot_distances(v, centre), centre, centre)
    every = ((v[:, None] - centre[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (best == every.min(1)).all()
    assert computed < 2 * len(v)


def test_sql_answer_agrees(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)], i % 3) for i in range(150)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in pivots.op12_pivots(spark, str(tmp_path)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert got == sorted(db.execute(pivots.ORACLE).fetchall())
