"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Letters of the lower-cased text, every other run of characters turned into one space, give n-grams of one to
three characters, hashed to ``DIMS`` buckets. A pass over all training texts counts document
frequencies per bucket. The regression is trained with follow-the-regularised-leader
(per-coordinate steps, L1 and L2 penalties) on a bounded sample, ``SAMPLE`` training
documents shared evenly by languages and picked by hash. A fifth of the sample is kept
aside to fit one temperature, which calibrates the scores.

Training uses only text and non-null lang of documents whose crc32(doc_id as text) mod 3 is
not 1 (a null doc_id trains nothing and isn't held out). Texts that are null or have no letter get
``und`` and score 0, and so does every text if nothing was learned. Texts are read whole, in blocks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import exact, table

DIMS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE = 6000
BLOCK = 1 << 20
NO_LANGUAGE = "und"
#: A text is accepted at this multiple of the score of pure chance, one by the number of languages, and at a half in any case.
OVER_CHANCE = 1.2


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str | None) -> np.ndarray | None:
    """Counts per bucket of the whole text; None if it has no letter."""
    if not text:
        return None
    counts, some, tail = np.zeros(DIMS, np.int64), False, np.array([32], np.uint32)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        alpha = _letters()[codes]
        some |= bool(alpha.any())
        codes = np.concatenate((tail, np.where(alpha, codes, np.uint32(32))))
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = codes[keep]
        known = min(len(tail), len(codes))
        value = np.zeros(len(codes), np.uint32)
        for n in ORDERS:  # value at i: hash of the n characters that end there
            shifted = np.zeros(len(codes), np.uint32)
            shifted[n - 1 :] = codes[: len(codes) - n + 1]
            value = (value + shifted + np.uint32(n)) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
            first = max(known, n - 1)
            counts += np.bincount(value[first:] * np.uint32(0x85EBCA6B) >> np.uint32(17), minlength=DIMS)
        tail = codes[-2:]
    return counts if some else None


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = np.zeros(DIMS, np.int64)
    for batch in batches:
        for text in batch.column(0):
            if (counts := grams(text.as_py())) is not None:
                docs += counts > 0
    at = np.flatnonzero(docs)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(docs[at], pa.int64())], names=["bucket", "docs"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets, counts = [], []
        for text in batch.column(2):  # a text's counts take 256 KB until they are sparse: one is held at a time
            found = grams(text.as_py())
            at = None if found is None else np.flatnonzero(found)
            buckets.append(None if at is None else at.astype(np.uint16).tobytes())
            counts.append(None if at is None else found[at].astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "pick", "buckets", "counts"])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / (np.sqrt(x @ x) or 1.0)


def train_ftrl(rows: list, classes: int, dims: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 1e-4) -> np.ndarray:
    """Weights (classes, dims + 1), the last column the bias, from rows (class, buckets, values)."""
    z, n = np.zeros((classes, dims + 1)), np.zeros((classes, dims + 1))

    def weights(at):
        return np.where(np.abs(z[:, at]) <= l1, 0.0, -(z[:, at] - np.sign(z[:, at]) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    order = np.random.default_rng(6)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, at, x = rows[i]
            w = weights(at)
            logits = w @ x
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            g = p[:, None] * x[None]
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    return weights(np.arange(dims + 1))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature in [1/16, 16] with the least negative log-likelihood, by golden section on its logarithm."""

    def loss(t: float) -> float:
        s = logits / math.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, ratio = -math.log(16), math.log(16), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _predictor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, idf, weights, temperature = model.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2):
                counts = grams(text.as_py()) if names else None
                if counts is None:
                    langs.append(NO_LANGUAGE)
                    scores.append(0.0)
                    continue
                at = np.flatnonzero(counts)
                logits = (weights[:, at] @ weighted(counts[at], idf[at]) + weights[:, -1]) / temperature
                p = np.exp(logits - logits.max())
                p /= p.sum()
                langs.append(names[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def train(spark: SparkSession, labelled: DataFrame, sample: int = SAMPLE):
    """(languages, idf, weights, temperature) from ``labelled`` (doc_id, text, lang).

    Fitted on at most ``sample`` documents, the same number of each language as far as there are; of more than ``sample``
    languages, the ``sample`` most frequent are learned, as the others would have no document among these.
    """
    labelled = labelled.where("lang IS NOT NULL")
    shares = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample).collect()
    if not shares:
        return [], None, None, 1.0
    names = sorted(r["lang"] for r in shares)
    counted = labelled.select("text").mapInArrow(_frequencies, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect()  # a row per bucket
    docs = np.zeros(DIMS)
    for r in counted:
        docs[r["bucket"]] = r["docs"]
    idf = np.log((1 + sum(r["count"] for r in shares)) / (1 + docs)) + 1
    each = sample / len(names)
    part = F.lit(0.0)
    for r in shares:
        part = F.when(F.col("lang") == r["lang"], min(1.0, each / r["count"])).otherwise(part)
    pick = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20))
    chosen = labelled.where(pick < part * (1 << 20)).select("lang", F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(5)).alias("pick"), "text")
    rows = chosen.mapInArrow(_sparse, "lang string, pick long, buckets binary, counts binary").where("buckets IS NOT NULL").limit(sample).collect()
    fit, aside = [], []
    for r in sorted(rows, key=lambda r: (r["lang"], r["buckets"], r["counts"])):
        at, counts = np.frombuffer(r["buckets"], np.uint16).astype(np.int64), np.frombuffer(r["counts"], np.uint32)
        row = names.index(r["lang"]), np.append(at, DIMS), np.append(weighted(counts, idf[at]), 1.0)
        (aside if r["pick"] == 0 else fit).append(row)
    if not fit:
        return [], None, None, 1.0
    weights = train_ftrl(fit, len(names), DIMS)
    logits = np.array([weights[:, at] @ x for _, at, x in aside]).reshape(-1, len(names))
    temperature = fit_temperature(logits, np.array([y for y, *_ in aside], np.int64)) if aside else 1.0
    return names, idf, weights.astype(np.float32), temperature


def identify(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang)."""
    docs = exact(docs, "doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = spark.sparkContext.broadcast(train(spark, docs.where(fold != 1), sample))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(_predictor(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def _accepted(model, least: float | None):
    predict = _predictor(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = min(0.5, OVER_CHANCE / max(len(model.value[0]), 1)) if least is None else least
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            blank = pa.nulls(len(text))
            (found,) = predict([pa.RecordBatch.from_arrays([blank, blank, text], names=["doc_id", "held_out", "text"])])
            keep = [lang != NO_LANGUAGE and score >= bound for lang, score in zip(found.column("lang_pred").to_pylist(), found.column("score").to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def accept(spark: SparkSession, docs: DataFrame, least: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of at least ``least``, columns as they are.

    Without ``least`` the bound is a half, or ``OVER_CHANCE`` times chance where that is lower.
    """
    used = exact(docs, "doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = spark.sparkContext.broadcast(train(spark, used.where(fold != 1), sample))
    return docs.mapInArrow(_accepted(model, least), docs.schema)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "documents"))
