"""Mixing sources to target weights along a time-varying curriculum.

Each source has a token target: its weight's share of all words, at most three times its
own words, what is over shared out again by weight (water level, solved in closed form over the
sources). A source's weight moves over training time t in [0, 1] along a line from ``start`` to
``end``. Its integral, scaled to the target, is the source's cumulative token demand; a
document that begins at word c of its source's stream is trained on at the time when the demand
reaches c. Streams repeat the source in a fixed hash order, so a source with target q times its
size gives each document floor(q) whole passes and the rest to the first documents of that order,
the last of them cut.

Running word counts are sums over hash buckets, then inside a bucket, so a source that holds
most of the rows is not one task's work. Null and wordless texts have size 0, take nothing and
have no position; a null source is a source, last in order; repeated rows each take their share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: (start, end) of the weight's line over training time, by place in WEIGHTS.
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
LIMIT = 3
ROWS_PER_BUCKET = 500


def source_targets(sizes: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, weight, slot, target from one row (source, source_size) per source.

    One row per source goes through one window; documents do not.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("slot", ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("slot") + 1).cast("long"))
    cap = F.col("source_size") * limit
    before = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    share = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = ranked.withColumn("level", left.cast("double") / share.cast("double"))
    open_ = F.when(cap.cast("double") > F.col("level") * F.col("weight"), F.col("level"))
    filled = filled.withColumn("water", F.first(open_, ignorenulls=True).over(Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(cap.cast("double"), F.coalesce(F.col("water") * F.col("weight"), cap.cast("double")))
    return filled.select("source", "source_size", "weight", "slot", target.alias("target"))


def time_of(done: Column, start: Column, end: Column) -> Column:
    """The training time at which the share ``done`` of a source's demand is reached.

    The demand up to t is (start t + (end - start) t^2 / 2) / ((start + end) / 2).
    """
    area = done * (start + end) / 2
    return F.when(start == end, done).otherwise((F.sqrt(start * start + 2 * (end - start) * area) - start) / (end - start))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, schedule=SCHEDULE, limit: int = LIMIT) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, positions for every row of ``docs``.

    ``positions`` holds the training time of each pass in which the document is taken.
    """
    stage = Stage(spark, "mix")
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    slim = exact(docs, "doc_id", "text", "source").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("h")
    )
    slim = stage(slim, "sizes")
    sizes = stage(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sources")
    rows = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bits = max(0, math.ceil(math.log2(rows / ROWS_PER_BUCKET))) if rows else 0
    slim = slim.withColumn("bucket", F.shiftright("h", 60 - bits))
    # sums of a bucket, then what the buckets before it hold
    buckets = slim.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("source", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    targets = source_targets(sizes.select("source", "source_size"), weights, limit)
    marked = buckets.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select("b.source", "bucket", "base", "source_size", "slot", "target")
    within = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = slim.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = run.alias("r").join(marked.alias("m"), F.col("r.source").eqNullSafe(F.col("m.source")) & (F.col("r.bucket") == F.col("m.bucket")))
    row = joined.select("doc_id", "size", "r.source", "source_size", "slot", "target", (F.col("base") + F.col("ahead")).alias("at"), F.floor(F.col("target") + 0.5).cast("long").alias("quota"))
    row = row.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - F.col("passes") * F.col("source_size") - F.col("at")))
    row = row.withColumn("taken", F.col("passes") * F.col("size") + extra)
    line = lambda i: F.element_at(F.array(*(F.lit(float(x[i])) for x in schedule)), F.col("slot") + 1)
    turns = F.when(F.col("taken") > 0, F.sequence(F.lit(0), F.expr("cast((taken - 1) div size as int)")))
    done = lambda p: (p * F.col("source_size") + F.col("at")).cast("double") / F.col("quota").cast("double")
    positions = F.transform(turns, lambda p: F.round(time_of(done(p), line(0), line(1)), 9))
    return row.select("doc_id", "size", "source", "source_size", "target", "taken", positions.alias("positions"))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per document and pass, sorted over the whole output by training position."""
    words = F.least(F.col("size"), F.col("taken") - F.col("turn") * F.col("size"))
    each = mixed.select("*", F.posexplode("positions").alias("turn", "position")).withColumn("words", words)
    return each.drop("positions").repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark, table(spark, sf_dir, "documents"))
    first = F.try_element_at("positions", F.lit(1)).alias("position")
    rows = mixed.select("doc_id", "size", "source_size", "target", "taken", first)
    return rows.repartitionByRange(F.col("position"), F.col("doc_id")).sortWithinPartitions("position", "doc_id")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1) % 3)::INT AS slot FROM s),
w AS (SELECT *, ([5, 2, 1])[slot + 1]::BIGINT AS weight, 3 * source_size AS cap FROM r),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, source COLLATE C ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, (cap / weight, slot)) AS water FROM f WHERE cap::DOUBLE > level * weight),
t AS (SELECT source, source_size, slot, least(cap::DOUBLE, coalesce(water * weight, cap::DOUBLE)) AS target FROM f, (SELECT max(water) AS water FROM l)),
a AS (
  SELECT d.*, t.source_size, t.slot, t.target, floor(target + 0.5)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS passes, [1.5, 1.0, 0.5][slot + 1]::DOUBLE AS s0, [0.5, 1.0, 1.5][slot + 1]::DOUBLE AS s1 FROM a),
c AS (SELECT *, (passes * size + greatest(0, least(size, quota - passes * source_size - begun)))::BIGINT AS taken, begun::DOUBLE / quota::DOUBLE AS u FROM b)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN round(CASE WHEN s0 = s1 THEN u ELSE (sqrt(s0 * s0 + 2 * (s1 - s0) * (u * (s0 + s1) / 2)) - s0) / (s1 - s0) END, 9) END AS position
FROM c
"""
