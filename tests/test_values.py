"""Number decode against Python's struct, for many bit patterns; schema texts; paths."""

import math
import random
import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklake.functions import paths
from tracklake.functions.binary import CODE
from tracklake.operators.entries import decode_cells
from tracklake.operators.schemas import parse_schema_text
from tracklake.sources.framing import cut, walk

FORMATS = {
    "int8": "<b", "int16": "<h", "int32": "<i", "int64": "<q",
    "uint8": "<B", "uint16": "<H", "uint32": "<I", "uint64": "<Q", "float": "<f", "double": "<d",
}


def test_numbers_bit_by_bit(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for kind, fmt in FORMATS.items():
        size = struct.calcsize(fmt)
        edges = [0, 1, (1 << (8 * size)) - 1, 1 << (8 * size - 1), (1 << (8 * size - 1)) - 1]
        if kind in ("float", "double"):
            exp, frac = (8, 23) if kind == "float" else (11, 52)
            top = ((1 << exp) - 1) << frac
            edges += [top, top | (1 << (8 * size - 1)), top + 1, (1 << frac) - 1, 1 << frac, top - 1]
        for bits in edges + [rng.getrandbits(8 * size) for _ in range(400)]:
            raw = bits.to_bytes(size, "little")
            want[len(rows)] = struct.unpack(fmt, raw)[0]
            rows.append((len(rows), CODE[kind], bytearray(raw)))
    cells = spark.createDataFrame(rows, "ts bigint, code int, bytes binary").selectExpr(
        "'r' recording", "'k' key", "ts", "0L eff", "0L seq", "code", "bytes", "cast(null as bigint) n"
    )
    for r in decode_cells(cells).collect():
        got = next(x for x in (r.v_long, r.v_dec, r.v_float, r.v_double) if x is not None)
        value = want[r.ts]
        if isinstance(value, float) and math.isnan(value):
            assert math.isnan(got), (r, value)
        else:
            assert got == value and math.copysign(1, got) == math.copysign(1, value), (r, value)


def parsed(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = parse_schema_text(df).orderBy("i").collect()
    return [([(f.field, f.type, f["count"], f.enum) for f in r.fields], r.incomplete) for r in rows]


def test_schema_texts(spark):
    multi = (
        "  enum  {  a  =  3  ,  }  int64  something  ;  int8  other  ;  "
        "enum  {  multi  =  64,  other=24  }  uint16  number_3[3]"
    )
    assert parsed(spark, "  bool  value  ", "  double  arr  [  4  ]  ", "  enum  {  }  int8  val", multi) == [
        ([("value", "bool", None, None)], False),
        ([("arr", "double", 4, None)], False),
        ([("val", "int8", None, {})], False),
        (
            [
                ("something", "int64", None, {"a": 3}),
                ("other", "int8", None, None),
                ("number_3", "uint16", 3, {"multi": 64, "other": 24}),
            ],
            False,
        ),
    ]


def test_odd_schema_texts(spark):
    assert parsed(
        spark, "", ";", "int8 a;", "int8 a; int8 b : 4; int8 c", "int8 a[0]", "{x=-1;y=+2} int8 a", "float32 a;float64 b",
        "int8 a; int16 a", "enum {x} int8 a", "enumx y", "int8", "Pose2d p;!", "enum{x=1,x=2}int8 a",
    ) == [
        ([], False),
        ([], False),
        ([("a", "int8", None, None)], False),
        ([("a", "int8", None, None), ("b", "int8", None, None)], True),
        ([("a", "int8", None, None)], False),
        ([("a", "int8", None, {"x": -1, "y": 2})], False),
        ([("a", "float", None, None), ("b", "double", None, None)], False),
        ([("a", "int16", None, None)], False),
        ([], True),
        ([("y", "enumx", None, None)], False),
        ([], True),
        ([("p", "Pose2d", None, None)], True),
        ([("a", "int8", None, {"x": 2})], False),
    ]


def test_paths(spark):
    names = ["NT:/a/b", "NT:NT:a", "///a//b/", "a", "", "a/./b/../c", "../a", "a/..", "NT:"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    clean = paths.clean_path(paths.normalise_name(F.col("n")))
    rows = df.withColumn("k", clean).select(
        "k", paths.parent_path(F.col("k")).alias("up"), paths.last_part(F.col("k")).alias("last"), paths.ancestors(F.col("k"))
    )
    got = [tuple(r)[:3] for r in rows.collect()]
    assert got == [
        ("a/b", "a", "b"), ("NT:a", "", "NT:a"), ("a/b", "a", "b"), ("a", "", "a"), ("", "", ""),
        ("a/c", "a", "c"), ("../a", "..", "a"), ("", "", ""), ("", "", ""),
    ]
    assert rows.collect()[0][3] == ["", "a"]
    times = spark.range(1).select(
        paths.robotime_nanos(F.lit(5)).alias("a"), paths.robotime_nanos(F.lit(1 << 62)).alias("b"),
        paths.robotime_interval(F.lit(1_500_000)).alias("c"),
    ).first()
    assert times.a == 5000 and times.b is None and times.c.total_seconds() == 1.5


record = st.tuples(
    st.integers(0, 3), st.integers(0, 3), st.integers(0, 7), st.integers(1, 255), st.binary(max_size=40), st.integers(0, 255)
)


@settings(max_examples=60, deadline=None)
@given(st.lists(record, min_size=1, max_size=30), st.binary(max_size=3))
def test_framing_round_trip(records, tail):
    """Every id, length and timestamp width, and a torn record at the end."""
    raw, want = b"", []
    for id_w, len_w, ts_w, entry, payload, ts in records:
        raw += bytes([id_w | len_w << 2 | ts_w << 4]) + entry.to_bytes(id_w + 1, "little")
        raw += len(payload).to_bytes(len_w + 1, "little") + ts.to_bytes(ts_w + 1, "little") + payload
        want.append((entry, ts, payload))
    starts, after = walk(raw + tail[:2], 0, len(raw) + len(tail[:2]), len(raw) + len(tail[:2]))
    assert after == len(raw) and len(starts) == len(records)
    batch = cut(raw, starts, after, "r", 5)
    rows = batch.to_pylist()
    assert [(r["entry_id"], r["ts"], r["data"]) for r in rows] == want
    assert [r["seq"] for r in rows] == list(range(5, 5 + len(rows)))
