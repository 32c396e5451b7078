"""The format ``wpilog``: records of log files through Spark's data source interface.

``register(spark)``, then ``spark.read.format("wpilog").load(path)`` gives the rows of
``ingest_path(spark, path).records``. Filters on recording, kind, entry_id and ts are pushed down: the first
decides which files are opened, the others which rows leave the task that frames them. Small files
share partitions; a large file is streamed by one task, whatever its size, or
read by range when ``read_records`` has found the entry points of its ranges.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from tracklake.sources.control import KINDS
from tracklake.sources.framing import CHUNK_BYTES, TRUNCATED, cut, walk
from tracklake.sources.logfiles import MAGIC, VERSION, WHOLE_FILE_BYTES, list_files, with_recording
from tracklake.sources.ranges import RANGE_BYTES, SCHEMES, large_logs, read_range

RECORDS_DDL = "recording string, seq bigint, ts bigint, kind string, entry_id bigint, entry_name string, entry_type string, metadata string, data binary"
RECORDS = pa.schema(
    [("recording", pa.string()), ("seq", pa.int64()), ("ts", pa.int64()), ("kind", pa.string()), ("entry_id", pa.int64()),
     ("entry_name", pa.string()), ("entry_type", pa.string()), ("metadata", pa.string()), ("data", pa.binary())]
)
#: Bytes of small files that one partition reads.
PACK_BYTES = 128 << 20
COMPARE = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}
PUSHED = ("recording", "kind", "entry_id", "ts")


@dataclass
class Piece:
    """A whole file, or a range of one whose entry point and first number are known."""

    recording: str
    path: str
    length: int
    entry: int | None = None
    leave: int | None = None
    seq: int = 0
    torn: bool = False


@dataclass
class Pieces(InputPartition):
    pieces: list[Piece]


def recording_of(path: str) -> str:
    stem = re.search(r"([^/]*?)(\.[^./]*)?$", path)[1]
    return f"{stem}-{hashlib.md5(path.encode()).hexdigest()[:16]}"


def listed(path: str, glob: str) -> list[tuple[str, int]]:
    """(path as Spark names it, bytes) of the files at or below ``path``."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        system, base, prefix = pafs.LocalFileSystem(), os.path.abspath("/" + rest.lstrip("/") if colon else path), "file:"
    else:
        system, base = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{quote(rest)}")
        prefix = f"{scheme}://" if scheme in ("s3", "s3a", "s3n") else f"{scheme}://{rest.lstrip('/').split('/')[0]}"
    info = system.get_file_info(base)
    found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(base, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found if f.is_file and fnmatch(f.base_name, glob) and not f.base_name.startswith(("_", ".")))


def _texts(data: bytes, at: int, n: int) -> list[str] | None:
    """``n`` texts, each behind its length; None where the payload ends before or a text isn't UTF-8."""
    out = []
    for _ in range(n):
        if len(data) < at + 4:
            return None
        size = int.from_bytes(data[at : at + 4], "little")
        raw = data[at + 4 : at + 4 + size]
        at += 4 + size
        try:
            out.append(raw.decode())
        except UnicodeDecodeError:
            return None
        if len(raw) < size:
            return None
    return out


def control_row(data: bytes) -> tuple | None:
    """(kind, entry_id, entry_name, entry_type, metadata) of a control payload; None if it cannot be read."""
    kind = KINDS.get(data[0]) if data else None
    if kind is None or len(data) < 5:
        return None
    texts = _texts(data, 5, {"start": 3, "set_metadata": 1}.get(kind, 0))
    if texts is None:
        return None
    name, of_type, metadata = texts if kind == "start" else (None, None, *(texts or [None]))
    return kind, struct.unpack_from("<I", data, 1)[0], name, of_type, metadata


def records_of(frames: pa.RecordBatch, strict: bool) -> pa.RecordBatch:
    """Frames as records, in their order; those that cannot be used are left out."""
    fine = pc.is_null(frames.column("issue"))
    control = pc.equal(frames.column("entry_id"), 0)
    at = pc.indices_nonzero(control).to_pylist()
    read = {i: control_row(frames.column("data")[i].as_py()) for i in at}
    lost = [i for i, r in read.items() if r is None]
    if strict and (lost or not pc.all(fine).as_py()):
        raise ValueError(f"{frames.column('recording')[0].as_py()}: unusable record")
    n = frames.num_rows
    columns = {"kind": ["raw"] * n, "entry_id": frames.column("entry_id").to_pylist() if at else None, "entry_name": [None] * n, "entry_type": [None] * n, "metadata": [None] * n}
    for i, row in read.items():
        for name, value in zip(columns, row or (None,) * 5, strict=True):
            columns[name][i] = value
    if not at:
        columns["entry_id"] = frames.column("entry_id")
    data = frames.column("data") if not at else pc.if_else(control, pa.scalar(None, pa.binary()), frames.column("data"))
    made = [frames.column("recording"), frames.column("seq"), frames.column("ts"), *(pa.array(c, RECORDS.field(k).type) for k, c in columns.items()), data]
    out = pa.RecordBatch.from_arrays(made, schema=RECORDS)
    return out.filter(pc.and_(fine, pc.is_valid(out.column("kind"))))


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("pathGlobFilter", "*.wpilog")
        self.strict = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.ranges = options.get("ranges")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if (type(f) in COMPARE or isinstance(f, In | IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                self.filters.append(f)
            else:
                yield f

    def _passing(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        for f in self.filters:
            column = batch.column(f.attribute[0])
            if isinstance(f, In):
                keep = pc.is_in(column, pa.array([v for v in f.value if v is not None], column.type))
            elif isinstance(f, IsNotNull):
                keep = pc.is_valid(column)
            else:
                keep = COMPARE[type(f)](column, pa.scalar(f.value, column.type))
            batch = batch.filter(keep)
        return batch

    def _wanted(self, recording: str) -> bool:
        one = pa.RecordBatch.from_pylist([{"recording": recording}], schema=RECORDS)
        chosen = LogReader.__new__(LogReader)
        chosen.filters = [f for f in self.filters if f.attribute == ("recording",)]
        return chosen._passing(one).num_rows == 1

    def partitions(self) -> Sequence[Pieces]:
        """Packs of small files, and a partition per large file, or per range of one where these are known."""
        known = [Piece(**p) for p in json.loads(self.ranges)] if self.ranges else []
        cut_up = {p.path for p in known}
        out, pack, size = [Pieces([p]) for p in known if self._wanted(p.recording)], [], 0
        for path, length in listed(self.path, self.glob):
            piece = Piece(recording_of(path), path, length)
            if path in cut_up or not self._wanted(piece.recording):
                continue
            if pack and size + length > PACK_BYTES:
                out.append(Pieces(pack))
                pack, size = [], 0
            pack.append(piece)
            size += length
        return [*out, Pieces(pack)] if pack or not out else out

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces:
            for frames in self._frames(piece):
                batch = self._passing(records_of(frames, self.strict))
                if batch.num_rows:
                    yield batch

    def _frames(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        """Frames of a piece, read some megabytes at a time, more where one record is longer."""
        at, end, seq, size = piece.entry, piece.leave, piece.seq, CHUNK_BYTES
        if at is None:
            at, end = self._body(piece), piece.length
        while at is not None and at < end:
            buf = read_range(piece.path, at, min(end, at + size))
            starts, after = walk(buf, 0, len(buf), len(buf))
            if starts:
                yield cut(buf, starts, after, piece.recording, seq)
                seq, at, size = seq + len(starts), at + after, CHUNK_BYTES
            elif at + size >= end:
                break
            else:
                size *= 2
        if self.strict and at is not None and (at < end or piece.torn):
            raise ValueError(f"{piece.recording}: {TRUNCATED} at byte {at}")

    def _body(self, piece: Piece) -> int | None:
        """Where the records of a file start; None if its header cannot be read."""
        head = bytes(read_range(piece.path, 0, 12))
        body = 12 + int.from_bytes(head[8:12], "little")
        if head[:6] != MAGIC:
            return None
        sound = len(head) == 12 and int.from_bytes(head[6:8], "little") == VERSION and body <= piece.length
        if sound:
            try:
                bytes(read_range(piece.path, 12, body)).decode()
                return body
            except UnicodeDecodeError:
                pass
        if self.strict:
            raise ValueError(f"{piece.recording}: unusable header")
        return None


class LogSource(DataSource):
    """Options: path, pathGlobFilter, mode (PERMISSIVE leaves unusable records out, FAILFAST raises), ranges."""

    @classmethod
    def name(cls) -> str:
        return "wpilog"

    def schema(self) -> str:
        return RECORDS_DDL

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LogSource)


def read_records(spark: SparkSession, path: str, glob: str = "*.wpilog", large: int = WHOLE_FILE_BYTES, range_bytes: int = RANGE_BYTES, **options) -> DataFrame:
    """Records of all log files below ``path``; files above ``large`` bytes are read by range, in parallel."""
    register(spark)
    reader = spark.read.format("wpilog").option("pathGlobFilter", glob).options(**options)
    big = with_recording(list_files(spark, path, glob).filter(F.col("length") > large))
    if not big.isEmpty():
        rows = large_logs(big, range_bytes).ranges.filter("entry is not null")
        torn = (F.col("leave") < F.col("hi")).alias("torn")
        # a row per range of 64 MiB: some 16 MB for a petabyte of large files
        found = rows.select("recording", "path", "length", "entry", "leave", "seq", torn).collect()
        reader = reader.option("ranges", json.dumps([r.asDict() for r in found]))
    return reader.load(path)
