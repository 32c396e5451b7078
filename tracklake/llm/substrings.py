"""Exact substring removal: every byte covered by a 100-byte string that also starts earlier.

Sharding. Of the 32-byte substrings of a 100-byte window, the one with the least hash (the
leftmost of equal ones) is the window's anchor; equal windows have equal anchors at equal offsets.
A first pass counts anchors. Only windows whose anchor stands in another place too go on.
Neighbouring windows with the same anchor travel as one piece of text and are routed by the bytes
that all of them share, so equal windows meet in one shard. Windows of very frequent anchors
travel in finer pieces, by the anchor's offset; they share more bytes, and so spread over
shards by what stands beside the frequent passage. Equal pieces that meet in a task, or in a
shard, go on once; the later ones are removed whole.

Each shard is sorted by external induced sorting (``suffix_sort``): suffixes with a common prefix of
100 bytes are equal windows, and all but the earliest are removed. Which windows are equal
is decided on bytes; hashes only route.

A document is (doc_id, text); null texts are empty. Rows that repeat a doc_id and text get the
same answer and don't remove each other. Rows with a null doc_id are left whole and remove nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table
from tracklake.llm.shingles import _powers_to, mixed
from tracklake.llm.suffix_sort import LIMIT, repeats

GRAM = 32
SPAN = LIMIT - GRAM + 1
#: Text bytes handled at a time; an anchor's place takes 20 bits beside its hash.
BLOCK = 1 << 19
_LOW = np.uint64((1 << 20) - 1)
#: Offsets of an anchor in its windows that travel together: usually, and for frequent anchors.
WIDTH, FINE_WIDTH = SPAN, 3
#: Bytes of pieces that are sorted together, in whole routes; a route of more is sorted alone.
SHARD_BYTES = 4 << 20
#: Documents from which on an anchor is frequent, and the most anchors that may be (they are broadcast: 0.8 MB).
FREQUENT, MOST_FREQUENT = 1000, 100_000
_CODES = np.random.default_rng(3).integers(1, 2**64, 256, dtype=np.uint64)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: suffix minima of one block and prefix minima of the next."""
    n = len(x)
    padded = np.full((-(-n // width) + 1) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _sums(data: np.ndarray) -> np.ndarray:
    power, _ = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * power[: len(data)], out=sums[1:])
    return sums


def _hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mixed((sums[stop] - sums[start]) * _powers_to(len(sums))[1][start])


def windows(data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: its start, prefix sums of hashes, and per window the anchor's 44-bit hash and offset in the window."""
    for begin in range(0, len(data) - LIMIT + 1, BLOCK):
        part = data[begin : begin + BLOCK + LIMIT - 1]
        sums, n = _sums(part), len(part) - GRAM + 1
        grams = mixed((sums[GRAM:] - sums[:n]) * _powers_to(len(sums))[1][:n])
        least = _sliding_min((grams & ~_LOW) | np.arange(n, dtype=np.uint64), SPAN)
        yield begin, sums, (least >> np.uint64(20)).astype(np.int64), (least & _LOW).astype(np.int64) - np.arange(len(least))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in any of the columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(route, key, n, own): an anchor of one document of the batch, or of n of them, or a document's anchors that others of the batch have too."""
    for batch in batches:
        per_doc, keys = [], batch.column(1).to_numpy()
        for text in batch.column(0).cast(pa.large_binary()):
            data = np.frombuffer(text.as_py() or b"", np.uint8)
            found = [a[_heads(a, o + np.arange(len(o)))] for _, _, a, o in windows(data)]
            place = np.concatenate(found) if found else np.zeros(0, np.int64)
            # an anchor at two places of one text repeats as well
            per_doc.append(np.unique(place, return_counts=True))
        doc = np.repeat(np.arange(len(per_doc)), [len(a) for a, _ in per_doc])
        anchor = np.concatenate([a for a, _ in per_doc]) if per_doc else np.zeros(0, np.int64)
        times = np.concatenate([n for _, n in per_doc]) if per_doc else np.zeros(0, np.int64)
        distinct, number, docs = np.unique(anchor, return_inverse=True, return_counts=True)
        total = np.bincount(number, times, len(distinct)).astype(np.int64)
        alone = (docs == 1) & (total == 1)
        single = alone[number]
        shared = np.flatnonzero(~single)
        heads = shared[_heads(doc[shared])] if len(shared) else shared
        lists = np.split(anchor[shared], np.flatnonzero(np.diff(doc[shared])) + 1) if len(shared) else []
        n = int(single.sum()), int((~alone).sum()), len(lists)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((anchor[single], distinct[~alone], -1 - np.abs(keys[doc[heads]])))),
                pa.array(np.concatenate((keys[doc[single]], np.zeros(n[1], np.int64), keys[doc[heads]])), mask=np.repeat([False, True, False], n)),
                pa.array(np.concatenate((np.ones(n[0], np.int64), total[~alone], np.zeros(n[2], np.int64)))),
                pa.array([None] * (n[0] + n[1]) + lists, pa.list_(pa.int64())),
            ],
            names=["route", "key", "n", "own"],
        )


def _joined(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans (doc_id, key, start, stop), those that meet made one."""
    out: list[tuple[int, int, int, int]] = []
    for d, k, s, e in sorted(spans):
        if out and out[-1][:2] == (d, k) and s <= out[-1][3]:
            out[-1] = d, k, out[-1][2], max(e, out[-1][3])
        else:
            out.append((d, k, s, e))
    return out


_PIECES = pa.schema([("route", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("piece", pa.binary())])


def _pieces(frequent):
    """Pieces of text whose windows may repeat; of equal ones of a batch the earliest, the others as removed spans (no piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[tuple[int, bytes], tuple[int, int, int]] = {}
            gone = []
            for doc_id, text, key, known in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("key").to_pylist(), batch.column("anchors"), strict=True):
                if doc_id is None or not known.is_valid:
                    continue
                raw = text.as_py()
                anchors = np.unique(known.values.to_numpy())
                for begin, sums, anchor, offset in windows(np.frombuffer(raw, np.uint8)):
                    at = _heads(offset + np.arange(len(offset)))
                    span = np.diff(np.append(at, len(anchor)))
                    keep = np.isin(anchor[at], anchors)
                    often = np.repeat(keep & np.isin(anchor[at], frequent.value), span)
                    keep = np.repeat(keep, span)
                    kind = np.where(often, 1000 + offset // FINE_WIDTH, offset // WIDTH)
                    at = _heads(offset + np.arange(len(offset)), kind)
                    end = np.append(at[1:], len(anchor))
                    at, end = at[keep[at]], end[keep[at]]
                    place, width = at + offset[at], np.where(often[at], FINE_WIDTH, WIDTH)
                    low = offset[at] // width * width  # all windows of the piece hold the bytes from place - low on
                    high = np.minimum(low + width - 1, SPAN - 1)
                    route = mixed(_hash(sums, place - low, place + LIMIT - high) + kind[at].astype(np.uint64)).view(np.int64)
                    for r, s, e in zip(route.tolist(), (at + begin).tolist(), (end + begin + LIMIT - 1).tolist()):
                        piece, mine = raw[s:e], (doc_id, s, key)
                        other = first.setdefault((r, piece), mine)
                        if other != mine:
                            if mine < other:
                                first[r, piece], other, mine = mine, mine, other
                            if mine[:2] != other[:2]:
                                gone.append((mine[0], mine[2], mine[1], mine[1] + len(piece)))
            rows = [(r, d, k, s, s + len(p), p) for (r, p), (d, s, k) in first.items()]
            rows += [(k, d, k, s, e, None) for d, k, s, e in _joined(gone)]
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 50_000]), _PIECES)], schema=_PIECES)

    return run


_SPANS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _spans_of(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SPANS)


def _later_windows(pieces: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """Of the windows of ``pieces`` (doc_id, start, key, piece), the spans of those that aren't the earliest of their kind."""
    doc, start, key = (np.array([p[i] for p in pieces], np.int64) for i in range(3))
    out = []
    for members, group in repeats(p[3] for p in pieces):
        r, begin = members[:, 0], start[members[:, 0]] + members[:, 1]
        order = np.lexsort((begin, doc[r], group))
        r, begin, group = r[order], begin[order], group[order]
        head = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(group)), 0))
        later = (doc[r] != doc[r[head]]) | (begin != begin[head])
        r, begin = r[later], begin[later]
        order = np.lexsort((begin, key[r], doc[r]))
        r, begin = r[order], begin[order]
        if len(r):  # windows in a row are one span
            heads = np.flatnonzero(np.append(True, (np.diff(begin) > 1) | (doc[r][1:] != doc[r][:-1]) | (key[r][1:] != key[r][:-1])))
            tails = np.append(heads[1:], len(r)) - 1
            out += zip(doc[r[heads]].tolist(), key[r[heads]].tolist(), begin[heads].tolist(), (begin[tails] + LIMIT).tolist(), strict=True)
    return out


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans given as removed, and those of repeated windows that aren't the earliest. Rows come sorted by route."""
    gone: list[tuple[int, int, int, int]] = []
    shard: list[tuple[int, int, int, bytes]] = []
    held, now, here = 0, None, {}

    def end_route() -> int:
        # a piece alone in its route repeats nothing
        if len(here) > 1:
            shard.extend((*of, piece) for piece, of in here.items())
            return sum(map(len, here))
        return 0

    for batch in batches:
        for route, doc, key, start, stop, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if piece is None:
                gone.append((doc, key, start, stop))
                continue
            if route != now:
                held += end_route()
                now, here = route, {}
                if held >= SHARD_BYTES:
                    gone += _later_windows(shard)
                    shard.clear()
                    held = 0
            mine = doc, start, key
            other = here.setdefault(piece, mine)
            if mine < other:
                here[piece], other, mine = mine, mine, other
            if mine[:2] != other[:2]:
                gone.append((mine[0], mine[2], mine[1], mine[1] + len(piece)))
        yield _spans_of(_joined(gone))
        gone.clear()
    end_route()
    if shard:
        gone += _later_windows(shard)
    yield _spans_of(_joined(gone))


def _kept(text: pa.Scalar, spans: pa.Scalar, doc_id: int | None) -> tuple[bytes, np.ndarray, int]:
    """The bytes of ``text`` outside the spans of ``doc_id``, which of its bytes are gone, and in how many runs."""
    raw = text.as_py() or b""
    gone = np.zeros(len(raw) + 1, np.int32)
    if spans.is_valid and doc_id is not None:
        mine = spans.values.field("doc_id").to_numpy() == doc_id
        np.add.at(gone, spans.values.field("start").to_numpy()[mine], 1)
        np.add.at(gone, spans.values.field("stop").to_numpy()[mine], -1)
    gone = np.cumsum(gone)[:-1] > 0
    n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes() if n_spans else raw, gone, n_spans


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("spans"), strict=True):
            kept, gone, n_spans = _kept(text, spans, doc_id)
            out.append((len(gone), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut_texts(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("spans"), strict=True):
                texts.append(_kept(text, spans, doc_id)[0].decode("utf-8", "ignore") if text.is_valid else None)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)

    return run


def _with_spans(spark: SparkSession, docs: DataFrame, frequent: int) -> DataFrame:
    """``docs`` with ``key`` and the ``spans`` to remove."""
    stage = Stage(spark, "substrings")
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    found = docs.where("doc_id IS NOT NULL").select("text", "key").mapInArrow(_anchors, "route long, key long, n long, own array<long>")
    total = found.selectExpr("*", "sum(n) OVER (PARTITION BY route) AS total")
    known = total.where(f"own IS NOT NULL OR total > 1 AND key IS NOT NULL OR total >= {frequent}")
    known = stage(known.selectExpr("key", "coalesce(own, array(route)) AS anchors", f"own IS NULL AND total >= {frequent} AS often", "total"), "anchors")
    often = known.where("often").select(F.element_at("anchors", 1).alias("anchor"), "total").distinct().orderBy(F.desc("total"), "anchor").limit(MOST_FREQUENT)
    often = spark.sparkContext.broadcast(np.array(sorted(r["anchor"] for r in often.collect()), np.int64))
    anchors = known.where("key IS NOT NULL").groupBy("key").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))
    pieces = docs.join(anchors, "key", "left").mapInArrow(_pieces(often), "route long, doc_id long, key long, start long, stop long, piece binary")
    spans = pieces.repartition("route").sortWithinPartitions("route").mapInArrow(_sorted_out, "doc_id long, key long, start long, stop long")
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("doc_id", "start", "stop")).alias("spans"))
    return docs.join(spans, "key", "left")


def remove_repeats(spark: SparkSession, docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs`` (doc_id, text)."""
    docs = exact(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return _with_spans(spark, docs, frequent).mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(spark: SparkSession, docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """The rows of ``docs`` with the repeats cut out of ``text``, and characters they cut into."""
    kept = exact(docs, *docs.columns).withColumn("doc_id", F.col("doc_id").cast("long"))
    return _with_spans(spark, kept, frequent).mapInArrow(_cut_texts(docs.columns), kept.schema)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, p, hash(substr(x, 2 * p + 1, 200)) AS h1, md5(substr(x, 2 * p + 1, 200)) AS h FROM (SELECT *, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, p) > 1),
i AS (SELECT doc_id, p, CASE WHEN p <= lag(p + 100) OVER o THEN 0 ELSE 1 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM i),
s AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, g),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM s),
c AS (SELECT k.doc_id, string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept,
    sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id
"""
