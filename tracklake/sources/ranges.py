"""Large log files in parallel, by byte range.

A range does not know where its first record starts, so it guesses an entry point and walks to its
exit; where every guess of a file equals the exit before it, all are exact. For a file with any other
guess the entries are computed: each range reads every byte as a record's start, which gives the bytes beyond
it that a record could end at; each range then maps those that lie in it to its own exits (all at once, by
pointer doubling); and the maps are composed along the file by pointer jumping from its first record, in
as many rounds as the number of ranges has binary digits, whatever the payloads look like. Only entries that another
range's map leads to take part.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote, unquote
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.session import stage, stage_counted
from tracklake.sources.framing import (
    FRAME_DDL,
    HEAD,
    HEAD_DDL,
    ID_WIDTH,
    LEN_AT,
    LEN_WIDTH,
    TRUNCATED,
    cut,
    torn_tail,
    walk,
)
from tracklake.sources.logfiles import MAGIC, VERSION

RANGE_BYTES = 64 << 20
#: File system schemes of Spark under the names that pyarrow has for them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
#: Bytes of a torn tail that are kept; only a tail beyond what a column value can hold is longer.
MAX_TAIL = (1 << 31) - (1 << 20)
LONGEST_HEAD = 17
PROBE_RECORDS = 24
CONTROL_KINDS = 3
#: Bytes whose exits are found at once; small enough for a processor's cache.
WINDOW = 1 << 16
NODE_DDL = "recording string, path string, at bigint"
LINK_DDL = "recording string, path string, at bigint, next bigint"
HEADER_DDL = (
    "recording string, path string, length bigint, version int, extra_header string, body_at bigint, header_issue string"
)
PROBE_DDL = (
    "recording string, path string, length bigint, block bigint, lo bigint, hi bigint, entry bigint, leave bigint, n bigint"
)


def open_file(path: str):
    """A seekable file by Spark's path: local names may hold any character, s3a and s3n are s3."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        name = "/" + rest.lstrip("/")
        return open(name if os.path.exists(name) else unquote(name), "rb")
    where = SCHEMES.get(scheme, scheme)
    system, name = pafs.FileSystem.from_uri(f"{where}:{quote(unquote(rest))}")
    return system.open_input_file(name)


def read_range(path: str, start: int, stop: int) -> memoryview:
    with open_file(path) as f:
        f.seek(start)
        return memoryview(f.read(max(0, stop - start))).cast("B")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            head = bytes(read_range(row["path"], 0, 12))
            if head[:6] != MAGIC:
                continue
            version = int.from_bytes(head[6:8], "little") if len(head) >= 8 else None
            body_at = 12 + int.from_bytes(head[8:12], "little") if len(head) == 12 else None
            issue, extra = None, None
            if version is not None and version != VERSION:
                issue = "unsupported version"
            elif body_at is None or body_at > row["length"]:
                issue = "truncated header"
            else:
                try:
                    extra = bytes(read_range(row["path"], 12, body_at)).decode()
                except UnicodeDecodeError:
                    issue = "invalid string"
            rows.append(
                {**row, "version": version, "extra_header": extra, "body_at": body_at, "header_issue": issue}
            )
        schema = pa.schema(
            [("recording", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("version", pa.int32()),
             ("extra_header", pa.string()), ("body_at", pa.int64()), ("header_issue", pa.string())]
        )
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _plausible(buf, pos: int, stop: int, end: int) -> bool:
    """Whether a chain of sound records starts at ``pos``."""
    for _ in range(PROBE_RECORDS):
        if pos >= stop:
            return True
        head = buf[pos]
        body = pos + HEAD[head]
        if head > 127 or body > end:
            return False
        ids, lens = ID_WIDTH[head], LEN_WIDTH[head]
        entry = int.from_bytes(buf[pos + 1 : pos + 1 + ids], "little")
        size = int.from_bytes(buf[pos + 1 + ids : pos + 1 + ids + lens], "little")
        if body + size > end:
            return False
        if entry == 0 and (size < 5 or (body < len(buf) and buf[body] >= CONTROL_KINDS)):
            return False
        pos = body + size
    return True


def _probe(row: dict) -> dict:
    lo, hi, length, entry = row["lo"], row["hi"], row["length"], row["entry"]
    if row["skip"]:
        return {**row, "entry": None, "leave": None, "n": 0}
    buf = read_range(row["path"], lo, min(length, hi + LONGEST_HEAD))
    stop, end = hi - lo, length - lo
    if entry is None:
        guess = next((p for p in range(stop) if _plausible(buf, p, stop, end)), None)
        if guess is None:
            return {**row, "entry": None, "leave": None, "n": 0}
        entry = lo + guess
    at, n = entry - lo, 0
    while at < stop:
        starts, after = walk(buf, at, stop, end)
        n += len(starts)
        if after == at:
            break
        at = after
    return {**row, "entry": entry, "leave": lo + at, "n": n}


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("recording", pa.string()), ("path", pa.string())]
        + [(c, pa.int64()) for c in ("length", "block", "lo", "hi", "entry", "leave", "n")]
    )
    for batch in batches:
        for row in batch.to_pylist():
            found = _probe(row)
            yield pa.RecordBatch.from_pylist([{k: found[k] for k in schema.names}], schema=schema)


def followers(raw: np.ndarray, n: int, end: int) -> np.ndarray:
    """For each of the first ``n`` bytes, where a record that starts there ends; -1 if that is beyond ``end``.

    ``raw`` holds at least ``LONGEST_HEAD`` bytes more than ``n``.
    """
    heads = raw[:n]
    width, length_at, body = (np.array(t, np.int64)[heads] for t in (LEN_WIDTH, LEN_AT, HEAD))
    at = np.arange(n)
    size = np.zeros(n, np.int64)
    for k in range(4):
        has = np.flatnonzero(width > k)
        size[has] |= raw[at[has] + length_at[has] + k].astype(np.int64) << (8 * k)
    after = at + body + size
    return np.where((at + body <= end) & (after <= end), after, -1)


def _bytes_of(row: dict) -> np.ndarray:
    """The bytes of a range and of the longest header that may begin in it, filled up with zeros at the file's end."""
    lo, hi = row["lo"], row["hi"]
    raw = np.frombuffer(read_range(row["path"], lo, min(row["length"], hi + LONGEST_HEAD)), np.uint8)
    return np.append(raw, np.zeros(hi - lo + LONGEST_HEAD - len(raw), np.uint8))


def _windows(raw: np.ndarray, row: dict, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, followers) of the windows of a range, all counted from the range's first byte."""
    n, end = row["hi"] - row["lo"], row["length"] - row["lo"]
    for first in range(0, n, window):
        stop = min(n, first + window)
        after = followers(raw[first:], stop - first, end - first)
        yield first, stop, np.where(after < 0, -1, after + first)


def exits_of_range(row: dict) -> np.ndarray:
    """All places behind the range, inside the file, where a record that starts in the range could end."""
    n, end = row["hi"] - row["lo"], row["length"] - row["lo"]
    found = [np.unique(after[(after >= n) & (after < end)]) for _, _, after in _windows(_bytes_of(row), row, 16 * WINDOW)]
    return np.unique(np.concatenate(found)) + row["lo"]


def map_of_range(row: dict, nodes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each of the ascending ``nodes`` in the range, where a walk from it leaves the range; -1 if it stops at a torn record.

    Walks that meet are one from there on.
    """
    nodes = nodes - row["lo"]
    live, mine = np.zeros(0, np.int64), np.zeros(len(nodes), np.int64)
    for first, stop, after in _windows(_bytes_of(row), row, window):
        while len(inner := np.flatnonzero((after >= first) & (after < stop))):  # each turn doubles the steps taken
            after[inner] = after[after[inner] - first]
        s, e = np.searchsorted(nodes, [first, stop])
        mine[s:e] = len(live) + np.arange(e - s)
        live = np.concatenate([live, nodes[s:e]])
        here = (live >= first) & (live < stop)
        live[here] = after[live[here] - first]
        live, index = np.unique(live, return_inverse=True)
        mine[:e] = index[mine[:e]]
    return np.where(live[mine] < 0, -1, live[mine] + row["lo"]) if len(nodes) else nodes


def _rows(row: dict, **columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns["at"])
    same = [pa.array([row[c]], pa.string()).take(pa.array(np.zeros(n, np.int32))) for c in ("recording", "path")]
    return pa.RecordBatch.from_arrays([*same, *(pa.array(c) for c in columns.values())], names=["recording", "path", *columns])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _rows(row, at=exits_of_range(row))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column(batch.schema.get_field_index("nodes"))
        for i, row in enumerate(batch.drop_columns(["nodes"]).to_pylist()):
            at = np.unique(nodes[i].values.to_numpy())
            after = map_of_range(row, at)
            done = (after < 0) | (after >= row["length"])
            part = _rows(row, at=at, next=after)
            yield part.set_column(3, "next", pa.array(after, mask=done))


@dataclass
class LargeLogs:
    headers: DataFrame  # one row per file
    ranges: DataFrame  # one row per range, with exact entry, leave, n and first seq


def _spread(df: DataFrame) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "path", "block")


def large_logs(files: DataFrame, range_bytes: int = RANGE_BYTES) -> LargeLogs:
    """Find the exact entry point of every range of the files (recording, path, length)."""
    headers = stage(files.select("recording", "path", "length").mapInArrow(_headers, HEADER_DDL), "headers")
    step = F.lit(range_bytes).cast("bigint")
    blocks = (
        headers.filter("header_issue is null and body_at < length")
        .withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("body_at") / step), F.floor((F.col("length") - 1) / step)))
        )
        .withColumn("lo", F.greatest(F.col("block") * step, F.col("body_at")))
        .withColumn("hi", F.least((F.col("block") + 1) * step, F.col("length")))
        .withColumn("entry", F.when(F.col("lo") == F.col("body_at"), F.col("lo")))
        .select("recording", "path", "length", "block", "lo", "hi", "entry", F.lit(False).alias("skip"))
    )
    state = stage(_spread(blocks).mapInArrow(_probes, PROBE_DDL), "ranges")
    by_file = Window.partitionBy("recording", "path").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("leave").over(earlier), F.col("lo"))
    # before lo: the walk ended in a torn record; at or after hi: a payload covers the range
    want = F.when((F.col("_reached") >= F.col("lo")) & (F.col("_reached") < F.col("hi")), F.col("_reached"))
    checked = state.withColumn("_reached", reached).withColumn("_bad", ~F.col("entry").eqNullSafe(want))
    wrong, n_wrong = stage_counted(checked.filter("_bad").select("recording", "path").distinct(), "wrong-guesses")
    if n_wrong:
        entries = _exact_entries(blocks.join(wrong, ["recording", "path"], "left_semi"), range_bytes)
        again = blocks.drop("entry", "skip").join(wrong, ["recording", "path"], "left_semi").join(entries, ["recording", "path", "block"], "left")
        again = again.withColumn("skip", F.col("entry").isNull()).select(*blocks.columns)
        right = state.join(wrong, ["recording", "path"], "left_anti").select(*state.columns)
        state = stage(right.unionByName(_spread(again).mapInArrow(_probes, PROBE_DDL)), "ranges")
    done = state.withColumn("seq", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))
    return LargeLogs(headers, done)


def _exact_entries(blocks: DataFrame, range_bytes: int) -> DataFrame:
    """(recording, path, block, entry) of the ranges in which a record starts, by composing the maps of the ranges."""
    file, node = ["recording", "path"], ["recording", "path", "at"]
    starts = blocks.filter("entry is not null").select(*file, F.col("entry").alias("at"))
    nodes = _spread(blocks).mapInArrow(_exits, NODE_DDL).unionByName(starts)
    block = F.floor(F.col("at") / F.lit(range_bytes).cast("bigint")).alias("block")
    # at most one node per byte of a range
    held = nodes.select(*file, block, "at").groupBy(*file, "block").agg(F.collect_set("at").alias("nodes"))
    links = stage(_spread(blocks.join(held, [*file, "block"])).mapInArrow(_maps, LINK_DDL), "range-links")
    # walks of a range meet, so most places that a record could lead to are on no way through the ranges before
    met = links.filter("next is not null").select(*file, F.col("next").alias("at")).unionByName(starts).distinct()
    links = links.join(met, node, "left_semi")
    state = stage(links.join(starts.withColumn("_start", F.lit(True)), node, "left").select(*node, "next", F.col("_start").isNotNull().alias("reached")), "range-maps")
    longest = blocks.groupBy(*file).count().agg(F.max("count")).first()[0]
    for _ in range((longest - 1).bit_length()):
        # twice as many ranges from the first record are known, and every link spans twice as many
        onward = state.select(*file, F.col("at").alias("next"), F.col("next").alias("_then"))
        marks = state.filter("reached and next is not null").select(*file, F.col("next").alias("at")).distinct().withColumn("_mark", F.lit(True))
        far = state.join(onward, [*file, "next"], "left").select(*node, F.col("_then").alias("next"), "reached")
        state = stage(far.join(marks, node, "left").select(*node, "next", (F.col("reached") | F.col("_mark").isNotNull()).alias("reached")), "range-maps")
    return state.filter("reached").select(*file, block, F.col("at").alias("entry"))


def scan_ranges(logs: LargeLogs, mode: str = "PERMISSIVE") -> DataFrame:
    """Header rows, frames and torn tails: the same rows as a whole-file scan gives."""
    strict = mode.upper() == "FAILFAST"
    bad = logs.headers.filter("header_issue is not null")
    if strict and not bad.isEmpty():
        raise ValueError(f"{bad.first()['recording']}: {bad.first()['header_issue']}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                entry, leave, seq = row["entry"], row["leave"], row["seq"]
                buf = read_range(row["path"], entry, leave)
                at, end = 0, leave - entry
                while at < end:
                    starts, after = walk(buf, at, min(end, at + (16 << 20)), end)
                    yield cut(buf, starts, after, row["recording"], seq)
                    seq += len(starts)
                    at = after
                if leave < row["hi"]:
                    if strict:
                        raise ValueError(f"{row['recording']}: {TRUNCATED} at byte {leave}")
                    # a BINARY value holds 2 GiB at most; of a longer tail the first bytes are kept
                    stop = min(row["length"], leave + MAX_TAIL)
                    yield torn_tail(row["recording"], seq, bytes(read_range(row["path"], leave, stop)))

    rows = logs.ranges.filter("entry is not null")
    head = F.struct("path", "version", "extra_header", F.col("length").alias("n_bytes"), F.col("header_issue").alias("issue"))
    headers = logs.headers.select("recording", head.cast(HEAD_DDL).alias("head"))
    return _spread(rows).mapInArrow(scan, FRAME_DDL).unionByName(headers, allowMissingColumns=True)
