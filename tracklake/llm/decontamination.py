"""Benchmark decontamination by spaced seeds.

Tokens are runs of letters and digits of the lower-cased text; in scripts written without spaces (Chinese,
Japanese, Thai, Lao, Burmese, Khmer, Tibetan) each letter is one. Each mask of ``MASKS`` slides over the tokens of
benchmark items and documents; the hash of a window covers the positions the mask keeps and
ignores the others, so a substituted token between kept ones doesn't hide a leak. Equal hashes are
hits; a hit fixes how item and document align. The item is then laid over the document at
that alignment, and the document is contaminated if some ``WINDOW`` item tokens in a row (all
tokens of a shorter item) agree in at least ``SHARE`` of their places. The masks leave no such leak without
a hit: of every choice of places that may disagree, in 9 to 15 tokens, some mask at some place keeps clear (a test enumerates them).

Benchmarks whose windows fit a checked size are broadcast, and texts are matched where they are
read; beyond that by a shuffled join. Distinct hits (document, item, alignment) are few; documents
with hits are read again for verification, by a broadcast of the hits if their number allows it.
Items of fewer than ``LEAST`` tokens are too short for seeds and substitutions: ``find_short_leaks`` reports the
documents that hold all their tokens in a row, by a hash of them; ``all_leaks`` reports both kinds.
Null and empty texts match nothing; repeated rows are each reported; rows with a null doc_id too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table

#: 1: the token counts, 0: any token may stand there. Fixed values, complete for WINDOW, SHARE and LEAST.
MASKS = ("111011", "11001011", "10100111")
WINDOW = 15
SHARE = 0.8
LEAST = 9
#: Windows of all items, and hits, that may be broadcast, some 30 bytes each.
BROADCAST_WINDOWS = 500_000


#: Characters of scripts written without spaces, and a range that holds them all, which is quicker to look for.
UNSPACED = r"[\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u1950-\u19DF\u1A20-\u1AAF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uA9E0-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF66-\uFF9F\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}]"
PERHAPS_UNSPACED = r"[\u0E00-\x{3FFFF}]"


def tokens(text: Column) -> Column:
    """Hashes of the tokens of ``text``, in order."""
    text = F.lower(text)
    apart = F.when(text.rlike(PERHAPS_UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    return F.transform(F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def seeds(words: Column, mask: str, number: int) -> Column:
    """A hash per place of ``mask`` in ``words``."""
    kept = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(words) - len(mask)
    at = lambda i: F.xxhash64(F.lit(number), *(F.get(words, i + k) for k in kept))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at))


def _windows(df: DataFrame, *keep: str) -> DataFrame:
    """A row per mask and place: seed, at, and the columns ``keep``."""
    all_ = F.array(*(F.coalesce(seeds(F.col("words"), m, n), F.array().cast("array<bigint>")) for n, m in enumerate(MASKS)))
    per_mask = df.select(*keep, F.explode(all_).alias("found"))
    return per_mask.select(*keep, F.posexplode("found").alias("at", "seed"))


def _agreement(words: Column, item: Column, shift: Column) -> Column:
    """Which tokens of ``item`` agree with ``words`` when item token j lies on words[j + shift]."""
    return F.transform(item, lambda x, j: F.coalesce(F.when(j + shift >= 0, F.get(words, F.greatest(j + shift, F.lit(0))) == x), F.lit(False)))


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, item_id, matched (agreeing tokens of the best window), agreeing (of the whole item), item_words, shift per contaminated pair."""
    stage = Stage(spark, "leaks")
    docs = exact(docs, "doc_id", "text").withColumn("key", F.xxhash64("doc_id", "text"))
    items = exact(benchmark, "item_id", "text").select("item_id", tokens(F.col("text")).alias("item")).where(F.size("item") >= LEAST).distinct()
    probes = stage(_windows(items.withColumnRenamed("item", "words"), "item_id").withColumnRenamed("at", "item_at"), "probes")
    items = stage(items, "items")
    few = probes.count() <= broadcast_windows
    held = docs.select("key", tokens(F.col("text")).alias("words"))
    found = _windows(held, "key").join(F.broadcast(probes) if few else probes, "seed")
    hits = stage(found.select("key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
    held = docs.join(F.broadcast(hits) if hits.count() <= broadcast_windows else hits, "key")
    held = held.select("doc_id", "item_id", "shift", tokens(F.col("text")).alias("words"))
    hits = held.join(F.broadcast(items) if few else items, "item_id")
    length = F.least(F.size("item"), F.lit(WINDOW))
    least = F.ceil(length * SHARE)
    laid = hits.withColumn("agree", _agreement(F.col("words"), F.col("item"), F.col("shift"))).withColumn("agreeing", F.size(F.filter("agree", lambda x: x)))
    laid = laid.where(F.col("agreeing") >= least).select("doc_id", "item_id", "shift", "agree", "agreeing", length.alias("length"), least.alias("least"), F.size("item").alias("item_words"))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.col("item_words") - F.col("length")), lambda s: F.size(F.filter(F.slice("agree", s + 1, F.col("length")), lambda x: x))))
    found = laid.withColumn("matched", best).where("matched >= least")
    top = F.max(F.struct("matched", "agreeing", "item_words", "shift")).alias("top")
    return found.groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", "top.*")


def find_short_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame | None:
    """As ``find_leaks``, for items of fewer than ``LEAST`` tokens, all of which must agree; None without such items."""
    docs, items = exact(docs, "doc_id", "text"), exact(benchmark, "item_id", "text").select("item_id", tokens(F.col("text")).alias("words"))
    items = items.where(F.size("words").between(1, LEAST - 1)).distinct()
    items = Stage(spark, "leaks")(items.select("item_id", F.size("words").alias("n"), F.xxhash64(F.size("words"), "words").alias("seed")), "short")
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # LEAST - 1 at most
    if not lengths:
        return None
    held = docs.select("doc_id", tokens(F.col("text")).alias("words"))
    all_ = F.array(*(F.coalesce(seeds(F.col("words"), "1" * n, n), F.array().cast("array<bigint>")) for n in lengths))
    found = held.select("doc_id", F.explode(all_).alias("found")).select("doc_id", F.posexplode("found").alias("at", "seed"))
    found = found.join(F.broadcast(items) if items.count() <= broadcast_windows else items, "seed")
    last = found.groupBy("doc_id", "item_id", "n").agg(F.max("at").alias("shift"))
    return last.select("doc_id", "item_id", F.col("n").alias("matched"), F.col("n").alias("agreeing"), F.col("n").alias("item_words"), "shift")


def all_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The leaks of long and short items, a row per contaminated pair."""
    long, short = find_leaks(spark, docs, benchmark, broadcast_windows), find_short_leaks(spark, docs, benchmark, broadcast_windows)
    if short is None:
        return long
    top = F.max(F.struct("matched", "agreeing", "item_words", "shift")).alias("top")
    return long.unionByName(short).groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", "top.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
