"""Bytes fixed by the format, decoded end to end."""

import pytest
from logs import HEADER

from tracklake.plans.ingest import ingest_contents
from tracklake.sources.logfiles import with_header

RAW = bytes.fromhex("20 01 08 40 42 0f 03 00 00 00 00 00 00 00")
START = bytes.fromhex(
    "20 00 1a 40 42 0f 00 01 00 00 00 04 00 00 00 74 65 73 74 05 00 00 00 69 6e 74 36 34 00 00 00 00"
)
FINISH = bytes.fromhex("20 00 05 40 42 0f 01 01 00 00 00")
METADATA = bytes.fromhex(
    "20 00 18 40 42 0f 02 01 00 00 00 0f 00 00 00 7b 22 73 6f 75 72 63 65 22 3a 22 4e 54 22 7d"
)


def files(spark, **contents):
    rows = [(name, bytearray(content)) for name, content in contents.items()]
    return spark.createDataFrame(rows, "path string, content binary")


def ingest(spark, *parts, **options):
    from pyspark.sql import functions as F

    return ingest_contents(files(spark, a=HEADER + b"".join(parts)), F.col("path"), **options)


@pytest.mark.parametrize(
    "content, version, extra, issue",
    [
        ("57 50 49 4c 4f 47 00 01 00 00 00 00", 256, "", None),
        ("57 50 49 4c 4f 47 00 01 01 00 00 00 61", 256, "a", None),
        ("57 50 49 4c 4f 47 00 01 01 00 00 00", 256, None, "truncated header"),
        ("57 50 49 4c 4f 47 00 02 00 00 00 00", 512, None, "unsupported version"),
        ("57 50 49 4c 4f 47 00 01 01 00 00 00 ff", 256, None, "invalid string"),
        ("57 50 49 4c 4f 47 00", None, None, "truncated header"),
    ],
)
def test_header(spark, content, version, extra, issue):
    row = with_header(files(spark, a=bytes.fromhex(content))).first()
    assert (row.version, row.extra_header, row.header_issue) == (version, extra, issue)


def test_bad_magic_is_skipped(spark):
    bad = bytes.fromhex("00 50 49 4c 4f 47 00 01 00 00 00 00")
    assert with_header(files(spark, a=bad, b=b"", c=b"WPI")).count() == 0


@pytest.mark.parametrize(
    "frame, want",
    [
        (RAW, ("raw", 1, None, None, None, bytes.fromhex("0300000000000000"))),
        (START, ("start", 1, "test", "int64", "", None)),
        (FINISH, ("finish", 1, None, None, None, None)),
        (METADATA, ("set_metadata", 1, None, None, '{"source":"NT"}', None)),
    ],
)
def test_record(spark, frame, want):
    row = ingest(spark, frame).records.first()
    assert (row.seq, row.ts) == (0, 1_000_000)
    assert (row.kind, row.entry_id, row.entry_name, row.entry_type, row.metadata) == want[:5]
    assert (bytes(row.data) if row.data is not None else None) == want[5]


def test_multi_record(spark):
    start = bytes.fromhex("20 00 2b 40 42 0f 00 01 00 00 00 05 00 00 00") + b"robot" + bytes.fromhex(
        "05 00 00 00"
    ) + b"int64" + bytes.fromhex("10 00 00 00") + b'{"source":"log"}'
    raw = bytes.fromhex("20 01 04 72 42 0f") + b"cool"
    end = bytes.fromhex("20 00 05 a4 42 0f 01 01 00 00 00")
    got = ingest(spark, start, raw, end)
    rows = got.records.orderBy("seq").collect()
    assert [(r.seq, r.ts, r.kind, r.entry_id) for r in rows] == [
        (0, 1_000_000, "start", 1),
        (1, 1_000_050, "raw", 1),
        (2, 1_000_100, "finish", 1),
    ]
    assert (rows[0].entry_name, rows[0].entry_type, rows[0].metadata) == ("robot", "int64", '{"source":"log"}')
    assert bytes(rows[1].data) == b"cool"
    bad = got.quarantine.collect()
    assert [(r.seq, r.key, r.n_bytes, r.stage, r.reason) for r in bad] == [
        (1, "robot", 4, "value", "too few bytes for a int64")
    ]
