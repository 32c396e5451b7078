"""SentencePiece encoding that keeps, for every piece, the bytes of the text it stands for, and decoding (op11).

Normalisation takes the longest prefix that the model's compiled character map holds, place by
place, and notes for every character it writes the byte of the text at which that prefix starts.
The library cuts the normalised text into pieces (its own normaliser is switched off for this);
piece lengths and the notes then give each piece its span. Rows are independent, so every text is
handled where it is read, in slices of some megabytes, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import exact, table

SPACE = "▁"
SLICE_BYTES = 1 << 20

# Fixed values of the model format: kinds of vocabulary entries.
USER_DEFINED, BYTE = 4, 6


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; a deployment passes its own path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches of at most ``limit`` bytes of text (or one row), with their texts, null ones empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(sizes):
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            part = batch.slice(start, stop - start)
            yield part, ["" if t is None else t for t in texts.slice(start, stop - start).to_pylist()]
            start = stop


def character_map(compiled: bytes) -> dict[str, str]:
    """Prefix -> replacement of a compiled map: a double-array trie, then the replacements, each ended by a zero byte."""
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64)
    jumps = (units >> 10) << np.where(units & 0x200, 8, 0)
    stored = compiled[4 + size :]
    labels = np.arange(1, 256)
    found, open_nodes = {}, [(int(jumps[0]), b"")]
    while open_nodes:
        base, key = open_nodes.pop()
        at = base ^ labels
        at = at[at < len(units)]
        for child in at[(units[at] & 0x800000FF) == (at ^ base)].tolist():
            longer, below = key + bytes([child ^ base]), child ^ int(jumps[child])
            if units[child] & 0x100:
                value = int(units[below]) & 0x7FFFFFFF
                found[longer.decode()] = stored[value : stored.index(0, value)].decode()
            open_nodes.append((below, longer))
    return found


class Normalizer:
    """A model's normalisation, with the byte of the text where each written character comes from."""

    def __init__(self, mapping: dict[str, str], symbols: list[str], prefix: bool, suffix: bool, squeeze: bool, escape: bool):
        self.mapping, self.prefix, self.suffix, self.squeeze, self.escape = mapping, prefix, suffix, squeeze, escape
        self.symbols = set(symbols)
        keys = sorted({*mapping, *symbols})
        self.lengths: dict[str, list[int]] = {}
        for key in keys:
            lengths = self.lengths.setdefault(key[0], [])
            if len(key) not in lengths:
                lengths.append(len(key))
        for lengths in self.lengths.values():
            lengths.sort(reverse=True)
        self.first = re.compile("[" + "".join(map(re.escape, sorted(self.lengths))) + "]") if keys else None

    def _prefix(self, text: str, at: int) -> tuple[str, int] | None:
        """What stands for the longest known prefix at ``at``, and its length; user-defined symbols stay and come first."""
        lengths = self.lengths[text[at]]
        for n in lengths if self.symbols else ():
            if (key := text[at : at + n]) in self.symbols:
                return key, len(key)
        for n in lengths:
            if (key := text[at : at + n]) in self.mapping:
                return self.mapping[key], len(key)
        return None

    def _mapped(self, text: str, offset: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
        """The text after the map, the byte each character comes from, and where a new prefix begins."""
        if self.first is None:
            return text, offset[:-1], np.ones(len(text), bool)
        out, starts, begins, done, look = [], [], [], 0, 0
        while hit := self.first.search(text, look):
            at = hit.start()
            found = self._prefix(text, at)
            if found is None:
                look = at + 1
                continue
            new, n = found
            out += [text[done:at], new]
            starts += [offset[done:at], np.full(len(new), offset[at])]
            begins += [np.ones(at - done, bool), np.arange(len(new)) == 0]
            done = look = at + n
        out.append(text[done:])
        starts.append(offset[done:-1])
        begins.append(np.ones(len(text) - done, bool))
        return "".join(out), np.concatenate(starts), np.concatenate(begins)

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and one more byte offset than it has characters: where each one, and the end, comes from."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        widths = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
        offset = np.concatenate([[0], np.cumsum(widths)])
        if not text:
            return "", offset
        new, start, begin = self._mapped(text, offset)
        lead = 0
        if self.squeeze:
            blank = np.frombuffer(new.encode("utf-32-le"), np.uint32) == 0x20
            chunk = np.cumsum(begin) - 1
            first = np.flatnonzero(begin)
            after = np.concatenate([[True], blank[:-1]])[first]  # does the prefix before end in a space
            other = np.where(~blank, np.arange(len(blank)), len(blank))
            inner = np.minimum.reduceat(other, first) if len(first) else other
            gone = blank & (np.arange(len(blank)) < inner[chunk]) & after[chunk] if len(first) else blank
            single = blank[first] & (np.diff(np.append(first, len(blank))) == 1)
            heading = len(single) if single.all() else int(np.argmin(single))
            if heading == len(first):
                return "", np.array([offset[-1]])
            lead = int(start[first[heading]])
            new = "".join(compress(new, (~gone).tolist()))
            start = start[~gone]
        if self.escape:
            new = new.replace(" ", SPACE)
        mark = SPACE if self.escape else " "
        if self.prefix and not self.suffix:
            new, start = mark + new, np.concatenate([[lead], start])
        end = offset[-1]
        if self.squeeze:
            kept = len(new.rstrip(mark))
            if kept < len(new):
                new, end, start = new[:kept], start[kept], start[:kept]
        if self.prefix and self.suffix:
            new, start = new + mark, np.append(start, end)
        return new, np.append(start, end)


class PieceEncoder:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        symbols = [p.piece for p in proto.pieces if p.type == USER_DEFINED]
        self.normalize = Normalizer(
            character_map(spec.precompiled_charsmap), symbols, spec.add_dummy_prefix,
            proto.trainer_spec.treat_whitespace_as_suffix, spec.remove_extra_whitespaces, spec.escape_whitespaces,
        )
        self.byte = np.full(len(proto.pieces), -1)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte[i] = int(p.piece[3:5], 16)
        self.chars = np.array([len(p.piece) for p in proto.pieces])
        self.end, self.unknown = self.whole.eos_id(), self.whole.unk_id()
        spec.Clear()
        spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "identity", False, False, False
        self.segment = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def _advance(self, ids: np.ndarray, text: str) -> np.ndarray:
        """Characters each piece covers; of the bytes of one character only the last covers it."""
        byte = self.byte[ids]
        if (ids == self.unknown).any():
            return np.array([len(p) for p in self.segment.encode(text, return_type=str)], np.int64)
        inner = (byte >= 0x80) & (byte < 0xC0)
        last = inner & ~np.append(inner[1:], False)
        return np.where(byte < 0, self.chars[ids], ((byte >= 0) & (byte < 0x80)) | last)

    def encode(self, texts: list[str], end: bool = True) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, first bytes and end bytes in the text, per text; an end id spans nothing at the text's end."""
        made = [self.normalize(t) for t in texts]
        out = []
        for (text, source), ids in zip(made, self.segment.encode([t for t, _ in made], num_threads=1, return_type="numpy"), strict=True):
            after = np.cumsum(self._advance(ids, text))
            before = np.concatenate([[0], after[:-1]]) if len(after) else after
            begins, ends = source[before.astype(np.int64)], source[after.astype(np.int64)]
            inner = (self.byte[ids] >= 0) & (before == after)  # an early byte of a character: an empty span at its start
            ends = np.where(inner, begins, ends)
            if end:
                ids, begins, ends = np.append(ids, self.end), np.append(begins, source[-1]), np.append(ends, source[-1])
            out.append((ids.astype(np.int32), begins.astype(np.int32), ends.astype(np.int32)))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids) if ids else []


@lru_cache(maxsize=2)
def encoder(model: bytes) -> PieceEncoder:
    return PieceEncoder(model)


def list_column(parts: list[np.ndarray], kind: pa.DataType = pa.int32()) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(parts) if parts else [], kind))


def encode(spark: SparkSession, docs: DataFrame, model: str, end: bool = True) -> DataFrame:
    """doc_id, ids, begins, ends for every row of ``docs`` (doc_id, text): piece i stands for bytes begins[i] to ends[i] of the text.

    ``model`` is the path of a SentencePiece model, read once by the driver. Ids are those that
    the library gives for the text, with its end id behind them if ``end``. The pieces' spans follow
    each other without gaps but for bytes that normalisation drops; a character encoded as bytes is spanned by
    the last of them. A null or empty text has the end id alone. Every row is kept, whatever its
    doc_id; other columns are ignored.
    """
    shared = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for part, texts in text_slices(batches, "text"):
            made = coder.encode(texts, end)
            yield pa.RecordBatch.from_arrays([part.column(0), *(list_column([m[i] for m in made]) for i in range(3))], names=["doc_id", "ids", "begins", "ends"])

    docs = exact(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(spark: SparkSession, encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``, what the model's library decodes the ids to; null ids give a null text."""
    shared = spark.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = part.column(1).to_pylist()
                texts = iter(coder.decode([i for i in ids if i is not None]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([None if i is None else next(texts) for i in ids], pa.string())], names=["doc_id", "ids", "text"])

    rows = exact(encoded, "doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    rows = decode(spark, encode(spark, table(spark, sf_dir, "documents"), model), model)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join("ids", " ")).alias("ids_sha256"), digest(F.col("text")).alias("decoded_sha256"),
    )
