"""Log bytes from DataFrame columns, for tests and for the registered queries.

The library has no log writer; this builds inputs. Records are encoded row by row with
column expressions and put into files with one ``listagg`` per file, so the caller must
group rows into files of a bounded number of records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.binary import reversed_bytes
from tracklake.sources.logfiles import MAGIC, VERSION


def le_int(value: Column, width: int) -> Column:
    """Two's-complement little-endian bytes of an integer column."""
    big = F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))
    return F.concat(*[F.substring(big, i, 1) for i in range(8, 8 - width, -1)])


def le_shortest(value: Column) -> tuple[Column, Column]:
    """(bytes, width) of a non-negative integer without its zero top bytes."""
    width = F.floor((F.length(F.hex(value.cast("bigint"))) + 1) / F.lit(2)).cast("int")
    return F.substring(le_int(value, 8), F.lit(1), width), width


def le_uint64(value: Column) -> Column:
    """Bytes of a DECIMAL(20,0) column holding an unsigned 64-bit value."""
    big = F.unhex(F.lpad(F.conv(value.cast("string"), 10, 16), 16, "0"))
    return reversed_bytes(big, 8)


def _fixed(values: np.ndarray, width: int, valid: np.ndarray) -> pa.Array:
    sizes = np.where(valid, width, 0)
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    body = values[valid].tobytes()
    return pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


@F.arrow_udf(T.BinaryType())
def le_double(values: pa.Array) -> pa.Array:
    return _fixed(values.fill_null(0).to_numpy(zero_copy_only=False).astype("<f8"), 8, np.ones(len(values), bool))


@F.arrow_udf(T.BinaryType())
def le_float(values: pa.Array) -> pa.Array:
    return _fixed(values.fill_null(0).to_numpy(zero_copy_only=False).astype("<f4"), 4, np.ones(len(values), bool))


@F.arrow_udf(T.BinaryType())
def le_floats(values: pa.Array) -> pa.Array:
    """Packed bytes of an ARRAY<FLOAT> column."""
    sizes = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum(sizes * 4, out=offsets[1:])
    body = values.flatten().to_numpy(zero_copy_only=False).astype("<f4").tobytes()
    return pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def le_text(text: Column) -> Column:
    raw = text.cast("binary")
    return F.concat(le_int(F.octet_length(raw), 4), raw)


def record(entry_id: Column, ts: Column, payload: Column) -> Column:
    """One frame, with the shortest id, length and timestamp fields."""
    ids, id_w = le_shortest(entry_id)
    size, size_w = le_shortest(F.octet_length(payload))
    stamp, stamp_w = le_shortest(ts)
    head = (id_w - 1) + (size_w - 1) * 4 + (stamp_w - 1) * 16
    return F.concat(le_int(head, 1), ids, size, stamp, payload)


def start(entry_id: Column, ts: Column, name: Column, entry_type: Column, metadata: Column) -> Column:
    body = F.concat(F.lit(b"\x00"), le_int(entry_id, 4), le_text(name), le_text(entry_type), le_text(metadata))
    return record(F.lit(0), ts, body)


def finish(entry_id: Column, ts: Column) -> Column:
    return record(F.lit(0), ts, F.concat(F.lit(b"\x01"), le_int(entry_id, 4)))


def set_metadata(entry_id: Column, ts: Column, metadata: Column) -> Column:
    return record(F.lit(0), ts, F.concat(F.lit(b"\x02"), le_int(entry_id, 4), le_text(metadata)))


def header(extra: Column) -> Column:
    return F.concat(F.lit(MAGIC + VERSION.to_bytes(2, "little")), le_text(extra))


def log_files(frames: DataFrame, extra: Column | None = None) -> DataFrame:
    """(path, content) from frames (recording, pos, frame): one file per recording, in ``pos`` order."""
    extra = F.lit("") if extra is None else extra
    body = frames.groupBy("recording").agg(F.expr("listagg(frame) within group (order by pos)").alias("body"))
    return body.select(
        "recording",
        F.concat(F.col("recording"), F.lit(".wpilog")).alias("path"),
        F.concat(header(extra), F.col("body")).alias("content"),
    )
