"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids (op13).

A document's tokens end at ascending byte offsets in either tokenizer. The shorter list of ends
drives a galloping search (exponential, then binary) through the longer one, which gives every driving end its rank there
and says whether both lists hold it. Shared ends cut the tokens into groups; differences of neighbouring ranks are the
ranges of tokens that overlap. Links are counted per task before they are shuffled, so an id pair that stands in a
third of all links costs one row a task; documents are never gathered.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table
from tracklake.llm.pieces import BYTE, SPACE, model_bytes, text_slices, tokenizer_path

#: Pairs whose counts may be broadcast: 17 bytes each, so 34 MB at most. More are joined.
BROADCAST_PAIRS = 2_000_000
#: Distinct pairs a task gathers before it passes them on: some 16 MB.
TASK_PAIRS = 1_000_000


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


# Fixed value of byte-level vocabularies: the pattern that splits a text before merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "byte_fallback": False, "ignore_merges": False}


def byte_level_encoder(file: bytes, token_bytes: list[bytes]):
    """Texts -> ids as the file's own library gives them, special tokens taken as plain text.

    Files of the plain kind, whose ids ascend in the order of their merges, are run as byte ranks, which is the same
    segmentation four times as fast; any other file runs in the library it was made for.
    """
    content = json.loads(file)
    model, before = content["model"], content["pre_tokenizer"] or {}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", [])]
    ids = [model["vocab"].get(m, -1) for m in merged]
    plain = all(model.get(k, v) == v for k, v in PLAIN_MODEL.items()) and content["normalizer"] is None
    if plain and ids == list(range(256, 256 + len(ids))) and (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) == ("ByteLevel", True, False):
        import tiktoken

        ranks = {token_bytes[i]: i for i in model["vocab"].values()}
        coder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [coder.encode_ordinary(t) for t in texts]
    from tokenizers import Tokenizer

    whole = Tokenizer.from_buffer(file)
    whole.encode_special_tokens = True
    return lambda texts: [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


class Tokenizers:
    """Both encoders, and the bytes of every token of theirs."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        alphabet, vocabulary = _byte_alphabet(), json.loads(byte_level)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry)
        self.encode_a = byte_level_encoder(byte_level, self.bytes_a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(pieces)
        self.bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.kind_a, self.kind_b = (np.min_scalar_type(len(t)) for t in (self.bytes_a, self.bytes_b))
        a, b = ([str(i) for i in range(len(t))] for t in (self.bytes_a, self.bytes_b))
        #: Ids with what follows them in the text of the groups: A's within and at the end of a group's A tokens, then B's.
        self.words = [f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both per text, none where a text is empty or the tokens' bytes aren't a space and the text."""
        a = self.encode_a([f" {t}" for t in texts])
        b = self.b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            want = b" " + text.encode()
            if not (text and b"".join(map(self.bytes_a.__getitem__, a[i])) == want == b"".join(map(self.bytes_b.__getitem__, b[i]))):
                a[i], b[i] = [], []
        return a, b


@lru_cache(maxsize=1)
def tokenizers(byte_level: bytes, pieces: bytes) -> Tokenizers:
    return Tokenizers(byte_level, pieces)


def gallop(driver: np.ndarray, longer: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each driving value in ``longer`` (values below it), and whether it stands there; both ascend.

    From its guess each value doubles its step, to the side where it must lie, until it is bracketed, then halves the bracket.
    All values step together.
    """
    n = len(longer)
    at = np.clip(guess, 0, n - 1)
    right = longer[at] < driver
    low, high = np.where(right, at, -1), np.where(right, n, at)  # longer[low] < value <= longer[high]
    open_, step = np.arange(len(driver)), 1
    while len(open_):
        up = right[open_]
        probe = at[open_] + np.where(up, step, -step)
        inside = (probe >= 0) & (probe < n)
        open_, probe, up = open_[inside], probe[inside], up[inside]
        below = longer[probe] < driver[open_]
        low[open_[below]], high[open_[~below]] = probe[below], probe[~below]
        open_, step = open_[below == up], step * 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = longer[middle] < driver[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high, np.append(longer, -1)[high] == driver


class Aligned:
    """Links and groups of some documents' tokens. Both tokenizers cover the same bytes, so the documents are laid end to end.

    ``a`` and ``b`` are all ids, ``of_a`` and ``of_b`` the places where each document's begin, and the end.
    """

    def __init__(self, models: Tokenizers, a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray):
        self.a, self.b, self.of_a, self.of_b = a.astype(np.int64), b.astype(np.int64), of_a, of_b
        ends = [np.cumsum(models.size_a[self.a]), np.cumsum(models.size_b[self.b])]
        swap = len(b) < len(a)
        (short, of_short), (long, of_long) = sorted(zip(ends, (of_a, of_b), strict=True), key=lambda x: len(x[0]))
        sizes, others = np.diff(of_short), np.diff(of_long)
        place = np.arange(len(short)) - np.repeat(of_short[:-1], sizes)
        rank, shared = gallop(short, long, np.repeat(of_long[:-1], sizes) + place * np.repeat(others, sizes) // np.repeat(np.maximum(sizes, 1), sizes))
        # driving token i overlaps the other tokens from where its first byte lies to where its last one lies
        first = np.concatenate([[0], (rank + shared)[:-1]]).astype(np.int64)[: len(short)]
        width = rank - first + 1
        through = np.concatenate([[0], np.cumsum(width)])
        driving = np.repeat(np.arange(len(short)), width)
        other = np.arange(len(driving)) + np.repeat(first - through[:-1], width)
        self.cut_a, self.cut_b = (rank[shared], np.flatnonzero(shared)) if swap else (np.flatnonzero(shared), rank[shared])  # last tokens of groups
        in_a, in_b = (other, driving) if swap else (driving, other)
        self.pairs = self.a[in_a] << 32 | self.b[in_b]
        #: Where each document's links begin, and the end.
        self.of_links = through[of_short]

    def n_groups(self) -> np.ndarray:
        return np.diff(np.searchsorted(self.cut_a, self.of_a))

    def groups(self, models: Tokenizers) -> list[str]:
        """Per document: per group its A ids, a bar and its B ids; groups apart by semicolons."""
        a, b = self.a.copy(), self.b + 2 * len(models.bytes_a)
        a[self.cut_a] += len(models.bytes_a)
        b[self.cut_b] += len(models.bytes_b)
        sizes = np.stack([np.diff(self.cut_a, prepend=-1), np.diff(self.cut_b, prepend=-1)], 1)
        is_a = np.repeat(np.tile([True, False], len(self.cut_a)), sizes.ravel())
        both = np.empty(len(a) + len(b), np.int64)
        both[is_a], both[~is_a] = a, b
        words = list(map(models.words.__getitem__, both.tolist()))
        at = (self.of_a + self.of_b).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip(at[:-1], at[1:], strict=True)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    of = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int32, of[-1]), of


def _packed(ids: np.ndarray, of: np.ndarray, kind: np.dtype) -> pa.Array:
    """A binary value per document: its ids in the narrowest type that holds the vocabulary."""
    offsets = pa.py_buffer((of * kind.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(of) - 1, [None, offsets, pa.py_buffer(ids.astype(kind).tobytes())])


def _unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    of = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)]) // kind.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), of


def _stored(models: Tokenizers, batch: pa.RecordBatch) -> Aligned:
    a, b = (_unpacked(batch.column(batch.schema.get_field_index(c)), k) for c, k in (("ids_a", models.kind_a), ("ids_b", models.kind_b)))
    return Aligned(models, *a, *b)


class LinkCounts:
    """Links per id pair of as much of a task as ``TASK_PAIRS`` allows."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray) -> None:
        fresh, n = np.unique(pairs, return_counts=True)
        self.keys, at = np.unique(np.concatenate([self.keys, fresh]), return_inverse=True)
        self.n = np.bincount(at, weights=np.concatenate([self.n, n]), minlength=len(self.keys)).astype(np.int64)

    def full(self) -> bool:
        return len(self.keys) > TASK_PAIRS


def _links_only(schema: pa.Schema, links: LinkCounts) -> pa.RecordBatch:
    """Rows (pair, n) in the schema of the documents' rows."""
    n = len(links.keys)
    return pa.RecordBatch.from_arrays([*(pa.nulls(n, f.type) for f in list(schema)[:-2]), pa.array(links.keys), pa.array(links.n)], schema=schema)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    return (batch.slice(start, rows) for batch in batches for start in range(0, batch.num_rows, rows))


def align(spark: SparkSession, docs: DataFrame, byte_level: str, pieces: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs`` (doc_id, text).

    ``byte_level`` and ``pieces`` are paths of a byte-level BPE file (A) and a SentencePiece model (B), read once by the
    driver. Texts that are null or empty, or that either tokenizer doesn't render byte for byte, have no tokens: zeros and ''.
    Rows may repeat a doc_id or have none; each is a document of its own. Other columns are ignored. Counts of id
    pairs are broadcast if there are at most ``broadcast_pairs`` of them; otherwise each document's distinct pairs are joined with them.
    """
    tables = Stage(spark, "alignment")
    shared = spark.sparkContext.broadcast((model_bytes(byte_level), model_bytes(pieces)))
    docs = exact(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, links = tokenizers(*shared.value), LinkCounts()
        kinds = None
        for part, texts in text_slices(batches, "text"):
            (a, of_a), (b, of_b) = map(_flat, models.encode(texts))
            made = Aligned(models, a, of_a, b, of_b)
            hashes = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in made.groups(models)]
            ids = [_packed(a, of_a, models.kind_a), _packed(b, of_b, models.kind_b)]
            sizes = [pa.array(np.diff(of)) for of in (of_a, of_b)]
            out = pa.RecordBatch.from_arrays([part.column(0), *ids, *sizes, pa.array(made.n_groups(), pa.int64()), pa.array(hashes, pa.string()), *[pa.nulls(len(texts), pa.int64())] * 2], names=names)
            kinds = out.schema
            yield out
            links.add(made.pairs)
            if links.full():
                yield _links_only(kinds, links)
                links = LinkCounts()
        if kinds is not None:
            yield _links_only(kinds, links)

    # rows of documents, and behind those of each task rows of pairs: one pass over the texts, one table
    schema = f"doc_id {kind}, ids_a binary, ids_b binary, n_a long, n_b long, n_groups long, groups_sha256 string, pair long, n long"
    names = ["doc_id", "ids_a", "ids_b", "n_a", "n_b", "n_groups", "groups_sha256", "pair", "n"]
    both = tables(docs.mapInArrow(encoded, schema).withColumn("row", F.monotonically_increasing_id()), "tokens")
    tokens = both.where("pair IS NULL").drop("pair", "n")
    counts = tables(both.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    most = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("most"))
    known = tables(counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")
    tables.drop("pairs")
    n_links = (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links")
    if known.count() <= broadcast_pairs:
        arrow = known.toArrow()
        order = np.argsort(arrow["pair"].to_numpy())
        small = spark.sparkContext.broadcast(tuple(arrow[c].to_numpy()[order] for c in ("pair", "n", "best")))

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            models, (keys, n, best) = tokenizers(*shared.value), small.value
            for part in _slices(batches):
                made = _stored(models, part)
                at = np.searchsorted(keys, made.pairs)
                sums = [np.diff(np.concatenate([[0], np.cumsum(v[at], dtype=np.int64)])[made.of_links]) for v in (best, n)]
                kept = part.drop_columns(["ids_a", "ids_b"])
                yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, sums)], names=[*kept.schema.names, "n_best", "count_sum"])

        rows = tokens.mapInArrow(scored, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, row long, n_best long, count_sum long")
        return rows.select("doc_id", "n_a", "n_b", "n_groups", n_links, "n_best", "count_sum", "groups_sha256")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = tokenizers(*shared.value)
        for part in _slices(batches):
            aligned = _stored(models, part)
            made = [np.unique(aligned.pairs[i:j], return_counts=True) for i, j in zip(aligned.of_links[:-1], aligned.of_links[1:], strict=True)]
            row = np.repeat(part.column(2).to_numpy(), [len(k) for k, _ in made])
            yield pa.RecordBatch.from_arrays([pa.array(row), *(pa.array(np.concatenate([m[i] for m in made]).astype(np.int64)) for i in (0, 1))], names=["row", "pair", "times"])

    # a pair that most documents hold is one row of ``known``: its hot side is split by the adaptive skew join, or broadcast
    links = tokens.select("ids_a", "ids_b", "row").mapInArrow(linked, "row long, pair long, times long")
    sums = links.join(known, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return tokens.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", n_links, zero("n_best"), zero("count_sum"), "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
