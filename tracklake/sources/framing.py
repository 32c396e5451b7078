"""Record framing: bytes of a log file to one row per record.

Frames have variable length and no sync marks, so the walk from one frame to the next is
the only step done per record in Python; fields and payloads are then cut out of the
buffer for a whole chunk at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

HEAD_DDL = "struct<path:string,version:int,extra_header:string,n_bytes:bigint,issue:string>"
FRAME_DDL = f"recording string, seq bigint, ts bigint, entry_id bigint, data binary, issue string, head {HEAD_DDL}"
HEAD_ARROW = pa.struct(
    [
        ("path", pa.string()),
        ("version", pa.int32()),
        ("extra_header", pa.string()),
        ("n_bytes", pa.int64()),
        ("issue", pa.string()),
    ]
)
FRAME_ARROW = pa.schema(
    [
        ("recording", pa.string()),
        ("seq", pa.int64()),
        ("ts", pa.int64()),
        ("entry_id", pa.int64()),
        ("data", pa.binary()),
        ("issue", pa.string()),
        ("head", HEAD_ARROW),
    ]
)
CHUNK_RECORDS = 1 << 16
CHUNK_BYTES = 16 << 20
TRUNCATED = "truncated record"
LATE = "timestamp out of range"

# Field widths by header byte: id bits 0-1, payload length bits 2-3, timestamp bits 4-6.
ID_WIDTH = [(b & 3) + 1 for b in range(256)]
LEN_WIDTH = [((b >> 2) & 3) + 1 for b in range(256)]
TS_WIDTH = [((b >> 4) & 7) + 1 for b in range(256)]
LEN_AT = [1 + i for i in ID_WIDTH]
HEAD = [1 + i + n + t for i, n, t in zip(ID_WIDTH, LEN_WIDTH, TS_WIDTH)]


def walk(buf, pos: int, stop: int, end: int, limit: int = CHUNK_RECORDS) -> tuple[list[int], int]:
    """Start offsets of whole records that begin in ``[pos, stop)``, and where the walk stood still.

    ``end`` is the end of readable bytes. The walk ends early after ``limit`` records or at
    a record that is not complete before ``end``.
    """
    starts: list[int] = []
    while pos < stop:
        head = buf[pos]
        body = pos + HEAD[head]
        if body > end:
            break
        at = pos + LEN_AT[head]
        width = LEN_WIDTH[head]
        size = buf[at] if width == 1 else int.from_bytes(buf[at : at + width], "little")
        after = body + size
        if after > end:
            break
        starts.append(pos)
        pos = after
        if len(starts) >= limit:
            break
    return starts, pos


def _read_field(raw: np.ndarray, at: np.ndarray, widths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(int(widths.max())):
        has = widths > k
        out[has] |= raw[at[has] + k].astype(np.uint64) << np.uint64(8 * k)
    return out


def cut(buf, starts: list[int], after: int, recording: str, seq: int) -> pa.RecordBatch:
    """Columns of the records at ``starts``; ``after`` is the end of the last one."""
    raw = np.frombuffer(buf, np.uint8)
    at = np.array(starts, np.int64)
    heads = raw[at]
    id_w, len_w, ts_w = (np.array(t, np.int64)[heads] for t in (ID_WIDTH, LEN_WIDTH, TS_WIDTH))
    head_w = 1 + id_w + len_w + ts_w
    ids = _read_field(raw, at + 1, id_w)
    stamps = _read_field(raw, at + 1 + id_w + len_w, ts_w)
    sizes = np.append(at[1:], after) - at - head_w
    # payloads = the region without its frame headers
    keep = np.ones(after - starts[0], bool)
    first = np.repeat(at - starts[0], head_w)
    inner = np.arange(len(first)) - np.repeat(np.cumsum(head_w) - head_w, head_w)
    keep[first + inner] = False
    payload = raw[starts[0] : after][keep]
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    late = stamps >= np.uint64(1 << 63)
    n = len(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([recording], pa.string()).take(pa.array(np.zeros(n, np.int32))),
            pa.array(seq + np.arange(n, dtype=np.int64)),
            pa.array(stamps.astype(np.int64), mask=late),
            pa.array(ids.astype(np.int64)),
            pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(payload)]),
            pa.array([LATE], pa.string()).take(pa.array(np.zeros(n, np.int32), mask=~late)),
            pa.nulls(n, HEAD_ARROW),
        ],
        schema=FRAME_ARROW,
    )


def _bytes_limit(buf, pos: int, end: int) -> int:
    return min(end, pos + CHUNK_BYTES)


def frames_of(buf, pos: int, recording: str, strict: bool) -> Iterator[pa.RecordBatch]:
    """All frames of one file, whole records first, then one row for a torn tail."""
    end = len(buf)
    seq = 0
    while pos < end:
        starts, after = walk(buf, pos, _bytes_limit(buf, pos, end), end)
        if starts:
            yield cut(buf, starts, after, recording, seq)
            seq += len(starts)
        if after == pos:  # no whole record is left
            if strict:
                raise ValueError(f"{recording}: {TRUNCATED} at byte {pos}")
            yield torn_tail(recording, seq, bytes(buf[pos:end]))
            return
        pos = after


def torn_tail(recording: str, seq: int, rest: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"recording": recording, "seq": seq, "data": rest, "issue": TRUNCATED}], schema=FRAME_ARROW
    )


def header_row(recording: str, head: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"recording": recording, "head": head}], schema=FRAME_ARROW)


def scan_frames(logs: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """One header row per log file, then its frames; every file is read once and never shuffled.

    ``logs`` comes from ``with_header``: (recording, path, content, version, extra_header,
    body_at, header_issue).
    """
    strict = mode.upper() == "FAILFAST"
    columns = ["recording", "content", "body_at", "path", "version", "extra_header", "header_issue"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([c for c in columns if c != "content"]).to_pylist()
            contents = batch.column(1)
            for i, row in enumerate(rest):
                buf = memoryview(contents[i].as_buffer()).cast("B")
                issue = row["header_issue"]
                if issue and strict:
                    raise ValueError(f"{row['recording']}: {issue}")
                yield header_row(
                    row["recording"],
                    {"path": row["path"], "version": row["version"], "extra_header": row["extra_header"],
                     "n_bytes": len(buf), "issue": issue},
                )
                if not issue:
                    yield from frames_of(buf, row["body_at"], row["recording"], strict)

    return logs.select(*columns).mapInArrow(scan, FRAME_DDL)
