"""Near-duplicates: MinHash bands find candidates, odd sketches sift them, full sets decide.

1. Every whole text becomes a set of word shingles, 512 MinHash values, 32 band keys of five
   values each, and an odd sketch: each (place, value) of the MinHash sample flips one bit of a
   1024-bit map. The XOR of two maps holds d flips as 512 (1 - (1 - 2/1024)^d) bits, so the
   share of equal values, which estimates the similarity, is read back from a population count.
2. Documents with equal sets (a 128-bit digest) are one class; only its smallest doc_id goes on.
3. A band bucket is dealt out in blocks of at most about ``BLOCK`` rows, each with the bucket's hubs, and a
   block yields the heaviest spanning forest of its estimated similarities: fewer pairs
   than rows. Full sets confirm or refuse them, and components form.
4. In buckets that still hold several components, rows are blocked by component and carry their full
   sets. A task that holds two blocks decides each pair of different components whose sketches are close, in
   the first band that the pair shares, and yields a spanning forest of the links: fewer rows than it read, however
   many pairs full sets refuse. Blocks of one and the same component never meet, so a hot group of near
   copies costs its size, not its square.

At the threshold 0.8 a pair shares no band with probability 3e-6; the sketch estimate
has a deviation of 0.02 there and is cut at 0.72.
Null or wordless texts have an empty set and no link. Rows that share a doc_id are one
node; rows with a null doc_id link with nothing and have a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, components, exact, table
from tracklake.llm.shingles import mixed, shingle_set

ROWS, BANDS, SAMPLE, BITS = 5, 32, 512, 1024
#: Estimated share of equal values below which a pair isn't worth its full sets.
SIFT = 0.72
BLOCK = 1024
#: Shingles for which a row of a block with full sets counts once more.
HEAVY = 1024
#: Ids that a broadcast may hold: 16 MB at most.
BROADCAST_IDS = 1_000_000
_rng = np.random.default_rng(9)
_A = (_rng.integers(0, 2**31, SAMPLE) * 2 + 1).astype(np.uint32)
_PLACE = np.arange(SAMPLE, dtype=np.uint64) << np.uint64(32)
_BAND = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def minhash(hashes: np.ndarray) -> np.ndarray:
    least = np.full(SAMPLE, 2**32 - 1, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, (short[at : at + 1024, None] * _A).min(axis=0), out=least)
    return least


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = _BAND.copy()
    for column in values[: BANDS * ROWS].reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def odd_sketch(values: np.ndarray) -> bytes:
    bits = mixed(_PLACE | values) % np.uint64(BITS)
    return np.packbits((np.bincount(bits.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def sketch_similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated share of equal MinHash values from the number of bits in the XOR of two sketches."""
    inside = np.maximum(1 - 2 * np.asarray(differing) / BITS, 1e-9)
    return 1 - np.log(inside) / np.log(1 - 2 / BITS) / (2 * SAMPLE)


#: By number of differing bits.
_ESTIMATE = sketch_similarity(np.arange(BITS + 1)).astype(np.float32)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, bands, sketches = [], [], [], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                found = shingle_set(text.as_py(), width)
                n.append(len(found))
                digest = np.frombuffer(blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                one.append(int(digest[0]))
                two.append(int(digest[1]))
                values = minhash(found) if len(found) else None
                bands.append(band_keys(values) if len(found) else None)
                sketches.append(odd_sketch(values) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"],
            )

    return run


def _estimates(maps: np.ndarray) -> np.ndarray:
    out = np.empty((len(maps), len(maps)), np.float32)
    for at in range(0, len(maps), 64):
        out[at : at + 64] = _ESTIMATE[np.bitwise_count(maps[at : at + 64, None] ^ maps[None]).sum(axis=2, dtype=np.int64)]
    return out


def _maps(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(rows), -1)


def _forest(rows: pa.Table) -> np.ndarray:
    """The heaviest spanning forest of a block by estimated similarity (Prim's steps, a row at a time)."""
    n, like = len(rows), _estimates(_maps(rows))
    best, near, done = np.full(n, -1, np.float32), np.zeros(n, np.int64), np.zeros(n, bool)
    pairs = []
    for _ in range(n):
        at = int(np.argmax(np.where(done, -2, best)))
        if best[at] >= SIFT:
            pairs.append((near[at], at))
        done[at] = True
        closer = ~done & (like[at] > best)
        best[closer], near[closer] = like[at][closer], at
    return np.array(pairs, np.int64).reshape(-1, 2)


def _links_across(percent: int):
    def run(rows: pa.Table) -> np.ndarray:
        """A spanning forest of the links between different components of two blocks, or of one with itself."""
        root, side, band = rows["component"].to_numpy().copy(), rows["side"].to_numpy(), rows["band"][0].as_py()
        maps, bands = _maps(rows), np.array(rows["bands"].to_pylist(), np.int64)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["hashes"]]
        size, alone = np.array([len(x) for x in sets]), bool(side.all())
        pairs = []
        for i in range(len(root) - 1):
            j = i + 1 + np.flatnonzero((root[i + 1 :] != root[i]) & (alone | (side[i + 1 :] != side[i])))
            j = j[100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i])]
            j = j[_ESTIMATE[np.bitwise_count(maps[j] ^ maps[i]).sum(axis=1, dtype=np.int64)] >= SIFT]
            j = j[bands[i][(bands[j] == bands[i]).argmax(axis=1)] == band]
            if not len(j):
                continue
            theirs = np.concatenate([sets[x] for x in j])
            at = np.minimum(np.searchsorted(sets[i], theirs), size[i] - 1)
            both = np.add.reduceat((sets[i][at] == theirs).astype(np.int64), np.cumsum(size[j]) - size[j])
            for x in j[100 * both >= percent * (size[i] + size[j] - both)]:
                if root[x] != root[i]:
                    pairs.append((i, x))
                    root[root == root[x]] = root[i]
        return np.array(pairs, np.int64).reshape(-1, 2)

    return run


def _grouped(pairs_of, *keys: str):
    """Pairs (a, b) of doc_ids from each group of rows that come sorted by ``keys``; one group is held beside a batch."""

    def found(rows: pa.Table, edges: np.ndarray) -> pa.RecordBatch:
        ids, first, second = rows["doc_id"].to_numpy(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi - lo > 1:
                pairs = pairs_of(rows.slice(lo, hi - lo)) + lo
                first.append(ids[pairs[:, 0]])
                second.append(ids[pairs[:, 1]])
        a, b = np.concatenate(first), np.concatenate(second)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if left is not None and len(left):
                rows = pa.concat_tables([left, rows]).combine_chunks()
            if not len(rows):
                continue
            new = np.zeros(len(rows), bool)
            new[0] = True
            for key in keys:
                of = rows[key].combine_chunks()
                new[1:] |= pc.not_equal(of[1:], of[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            yield found(rows, starts)
            left = rows.slice(starts[-1])
        if left is not None and len(left):
            yield found(left, np.array([0, len(left)]))

    return run


def _by_group(rows: DataFrame, pairs_of, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(_grouped(pairs_of, *keys), "a long, b long")


def _meetings(placed: DataFrame, stage: Stage) -> DataFrame:
    """(band, meeting, side, doc_id, component): rows of buckets with several components, by pairs of blocks.

    ``side`` is true for rows of the pair's first block. A row counts once, and once more per ``HEAVY`` shingles.
    """
    open_ = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band")
    weight = F.sum(1 + F.floor(F.col("n_shingles") / HEAVY)).alias("held")
    parts = placed.join(open_, "band", "left_semi").groupBy("band", "component").agg(weight)
    small = parts.where(F.col("held") < BLOCK).groupBy("band").agg(F.sum("held").alias("small"))
    big = F.col("held") >= BLOCK
    pieces = F.ceil(F.col("held") / BLOCK).cast("int")
    pool = F.pmod(F.xxhash64("component"), F.ceil(F.col("small") / BLOCK)).cast("int")
    parts = parts.join(small, "band", "left").select("band", "component", big.alias("big"), F.when(big, pieces).alias("pieces"), F.when(~big, pool).alias("pool"))
    own = F.struct(F.col("component").alias("c"), F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int").alias("k"))
    shared = F.struct(F.lit(None).cast("long").alias("c"), F.col("pool").alias("k"))
    cut = stage(placed.join(parts, ["band", "component"]).select("band", "doc_id", "component", F.when(F.col("big"), own).otherwise(shared).alias("block")), "cut")
    named = cut.select("band", "block").distinct()
    same = F.coalesce(F.col("x.block.c") == F.col("y.block.c"), F.lit(False))
    met = named.alias("x").join(named.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.block") <= F.col("y.block")) & ~same)
    met = met.select("x.band", F.struct(F.col("x.block").alias("p"), F.col("y.block").alias("q")).alias("meeting"))
    met = met.select("band", "meeting", F.explode(F.array_distinct(F.array("meeting.p", "meeting.q"))).alias("block"))
    name = F.concat_ws("/", *(F.coalesce(F.col(f"meeting.{of}").cast("string"), F.lit("-")) for of in ("p.c", "p.k", "q.c", "q.k")))
    return cut.join(met, ["band", "block"]).select("band", name.alias("meeting"), (F.col("block") == F.col("meeting.p")).alias("side"), "doc_id", "component")


def _hashed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), width).tobytes() for text in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    return run


def _sets(stage: Stage, docs: DataFrame, ids: DataFrame, width: int, name: str) -> DataFrame:
    """(doc_id, hashes): the full shingle set of each of ``ids``, eight bytes a shingle, ascending."""
    ids = stage(ids.distinct(), f"{name}-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_hashed(width), "doc_id long, hashes binary")
    sets = stage(sets.dropDuplicates(["doc_id"]), f"{name}-sets")
    stage.drop(f"{name}-ids")
    return sets


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(stage: Stage, pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the distinct pairs that full sets confirm."""
    pairs = stage(pairs.distinct(), "pairs")
    sets = _sets(stage, docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), width, "first")
    right = pairs.join(sets.withColumnsRenamed({"doc_id": "b", "hashes": "sb"}), "b")
    both = right.join(sets.withColumnsRenamed({"doc_id": "a", "hashes": "sa"}), "a").select("a", "b", "sa", "sb")
    out = stage(both.mapInArrow(_confirm(percent), "a long, b long"), "links")
    stage.drop("pairs", "first-sets")
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80, stage: Stage | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text), read from tables of ``stage``."""
    stage = stage or Stage(spark, "minhash")
    docs = exact(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary"
    every = stage(docs.mapInArrow(_signatures(width), schema), "signatures")
    able = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(able.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = able.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    reps = stage(reps.select("doc_id", "n_shingles", "bands", "sketch").dropDuplicates(["doc_id"]), "reps")
    # rows of buckets with company
    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    spread = F.xxhash64("doc_id")
    shared = banded.groupBy("band").agg(
        F.count("doc_id").alias("n"), F.array(F.min("doc_id"), F.max("doc_id"), F.min(F.struct(spread, "doc_id"))["doc_id"]).alias("hubs")
    )
    buckets = stage(banded.join(shared.where("n > 1"), "band"), "buckets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.when(F.array_contains("hubs", F.col("doc_id")), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.pmod(spread, blocks).cast("int")))
    dealt = buckets.select("doc_id", "band", F.explode(own).alias("block")).join(reps.select("doc_id", "sketch"), "doc_id")
    links = _confirmed(stage, _by_group(dealt, _forest, "band", "block"), docs, width, percent)
    # buckets in which several components are left
    settled = stage(components(spark, links, "minhash-first", stage=stage), "settled")
    placed = buckets.select("band", "doc_id").join(settled.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    placed = stage(placed.join(reps.select("doc_id", "n_shingles"), "doc_id"), "placed")
    met = stage(_meetings(placed, stage), "met")
    sets = _sets(stage, docs, met.select("doc_id"), width, "met")
    rows = met.join(reps.select("doc_id", "bands", "sketch").join(sets, "doc_id"), "doc_id")
    across = stage(_by_group(rows, _links_across(percent), "band", "meeting"), "across")
    # the stars of the components so far stand for their links
    links = settled.selectExpr("id AS a", "component AS b").unionByName(across)
    stage.drop("placed", "cut", "met", "met-sets", "reps", "buckets")
    final = components(spark, links, "minhash-last", stage=stage).withColumnsRenamed({"id": "rep", "component": "joined"})
    # the classes' members follow their representative
    members = every.select("doc_id", "n_shingles", "f1", "f2").join(classes.join(final, "rep", "left"), ["n_shingles", "f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("joined", "rep", "doc_id"))
    return members.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), width=2)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
f AS (SELECT hash(list_sort(s)) AS f, min(doc_id) AS rep, any_value(len(s)) AS n, list(doc_id) AS ids FROM s WHERE len(s) > 0 GROUP BY f),
x AS (SELECT rep, n, unnest(s) AS g FROM f JOIN s ON s.doc_id = f.rep),
p AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r(id, c) AS (SELECT rep, rep FROM f UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.c),
c AS (SELECT id, min(c) AS c FROM r GROUP BY id),
m AS (SELECT unnest(ids) AS doc_id, c FROM f JOIN c ON c.id = f.rep)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, coalesce(c, s.doc_id) AS component_id, coalesce(c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN m ON m.doc_id = s.doc_id
"""
