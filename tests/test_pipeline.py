"""Semantics of the whole chain on small hand-written logs."""

import math
import struct

import pytest
from logs import f64, finish, i64, log, note, rec, start
from pyspark.sql import functions as F

from tracklake.plans.ingest import ingest_contents


def ingest(spark, options=None, **contents):
    rows = [(name, bytearray(content)) for name, content in contents.items()]
    files = spark.createDataFrame(rows, "path string, content binary")
    return ingest_contents(files, F.col("path"), **(options or {}))


def values(got, columns=("v_bool", "v_long", "v_dec", "v_float", "v_double", "v_string", "v_binary")):
    out = {}
    for r in got.entries.collect():
        known = [r[c] for c in columns if r[c] is not None]
        out[(r.key, r.ts)] = known[0] if known else None
    return out


def reasons(df):
    return sorted((r.seq, r.stage, r.reason) for r in df.collect())


def test_scalars_arrays_and_bad_values(spark):
    parts = [
        start(1, "NT:/a/b", "boolean"), rec(1, 5, b"\x02"), rec(1, 6, b"\x00"), rec(1, 7, b""),
        start(2, "NT:NT:x", "int64"), rec(2, 1, i64(-7) + b"extra"),
        start(3, "//f", "float"), rec(3, 1, struct.pack("<f", 1.5)), rec(3, 2, b"abc"),
        start(4, "/d/./e/../g//h", "double"), rec(4, 1, f64(-0.0)), rec(4, 2, f64(math.nan)), rec(4, 3, f64(5e-324)),
        start(5, "s", "string"), rec(5, 1, b"ok\xffz"),
        start(6, "r", "raw"), rec(6, 1, b"\x00\xff"),
        start(7, "arr", "int64[]"), rec(7, 1, i64(4) + i64(-5)), rec(7, 2, b""), rec(7, 3, b"123"),
        start(8, "flags", "boolean[]"), rec(8, 1, b"\x01\x00"),
        start(9, "j", "json"), rec(9, 1, b"{}"),
        start(10, "t", "string[]"), rec(10, 1, b"x"),
        start(11, "u", "color"), rec(11, 1, b"x"),
        rec(77, 3, b"lost"),
    ]
    got = ingest(spark, a=log(*parts))
    v = values(got)
    nan = v.pop(("d/g/h", 2))
    assert math.isnan(nan)
    assert math.copysign(1, v[("d/g/h", 1)]) == -1
    assert v == {
        ("a/b", 5): True, ("a/b", 6): False, ("a/b", 7): None,
        ("NT:x", 1): -7, ("f", 1): 1.5, ("d/g/h", 1): 0.0, ("d/g/h", 3): 5e-324,
        ("s", 1): "ok�z", ("r", 1): b"\x00\xff",
        ("arr/length", 1): 2, ("arr/0", 1): 4, ("arr/1", 1): -5, ("arr/length", 2): 0,
        ("flags/length", 1): 2, ("flags/0", 1): True, ("flags/1", 1): False,
    }
    assert [r[1:] for r in reasons(got.quarantine)] == [
        ("value", "too few bytes for a float"),
        ("value", "trailing partial element"),
        ("value", "json values are not decoded"),
        ("value", "string has no array form"),
        ("value", "no such type"),
        ("context", "no context"),
    ]


def test_file_order_decides_context_and_last_write(spark):
    parts = [
        rec(1, 9, f64(0)),  # before any Start
        start(1, "first", "double", ts=900), rec(1, 10, f64(1)), rec(1, 5, f64(2)),
        finish(1), rec(1, 11, f64(3)),  # a Finish does not end the entry
        start(1, "second", "int64", metadata="m0"), rec(1, 10, i64(4)), note(1, "m1"),
        start(2, "/first", "double"), rec(2, 10, f64(5)),  # same key, later in the file
    ]
    got = ingest(spark, a=log(*parts), b=log(start(1, "first", "double"), rec(1, 10, f64(8))))
    rows = {(r.recording, r.key, r.ts): (r.v_double, r.v_long) for r in got.entries.collect()}
    assert rows == {
        ("a", "first", 10): (5.0, None),
        ("a", "first", 5): (2.0, None),
        ("a", "first", 11): (3.0, None),
        ("a", "second", 10): (None, 4),
        ("b", "first", 10): (8.0, None),
    }
    defs = {
        (r.recording, r.entry_id, r.start_seq): (r.end_seq, r.finish_seq, r.key, r.entry_type, r.metadata)
        for r in got.entry_defs.collect()
    }
    assert defs == {
        ("a", 1, 1): (6, 4, "first", "double", ""),
        ("a", 1, 6): (None, None, "second", "int64", "m1"),
        ("a", 2, 9): (None, None, "first", "double", ""),
        ("b", 1, 0): (None, None, "first", "double", ""),
    }


def test_torn_tail_and_bad_control(spark):
    whole = log(start(1, "k", "int64"), rec(1, 1, i64(1)))
    torn = whole + rec(1, 2, i64(2))[:-3]
    bad = log(start(1, "k", "int64"), rec(0, 0, b"\x09\x01\x00\x00\x00"), rec(0, 0, b"\x00"), rec(1, 1, i64(3)))
    late = log(start(1, "k", "int64"), rec(1, 1 << 63, i64(3)))
    got = ingest(spark, torn=torn, bad=bad, late=late)
    assert {(r.recording, r.key, r.ts, r.v_long) for r in got.entries.collect()} == {
        ("torn", "k", 1, 1), ("bad", "k", 1, 3),
    }
    found = sorted((r.recording, r.seq, r.stage, r.reason) for r in got.quarantine.collect())
    assert found == [
        ("bad", 1, "record", "unknown control record"),
        ("bad", 2, "record", "truncated control record"),
        ("late", 1, "record", "timestamp out of range"),
        ("torn", 2, "record", "truncated record"),
    ]
    for name, content in (("torn", torn), ("bad", bad)):
        with pytest.raises(Exception):
            ingest(spark, {"mode": "FAILFAST"}, **{name: content}).records.count()


POSE = "double x; float32 y;enum{a=1,b=-2;} int8 mode;\n uint16 w[2]; char tag[4]; bool on; uint64 big;uint32 u;int32 i;char c"
POSE_FORMAT = "<dfbHH4s?QIic"


def pose(x=1.5):
    return struct.pack(POSE_FORMAT, x, 0.25, -3, 1, 65535, b"ab\x00\x00", True, 2**64 - 1, 2**32 - 1, -9, b"q")


def test_struct_fields(spark):
    parts = [
        start(1, "/.schema/struct:Pose", "structschema"), rec(1, 0, POSE.encode()),
        start(2, "p", "struct:Pose"), rec(2, 4, pose() + b"more"), rec(2, 5, pose()[:-1]),
        start(3, "q", "struct:Pose[]"), rec(3, 6, pose(1) + pose(2)), rec(3, 7, b""), rec(3, 8, b"x"),
    ]
    got = ingest(spark, a=log(*parts))
    v = values(got)
    leaves = {
        "y": 0.25, "mode": -3, "w/length": 2, "w/0": 1, "w/1": 65535, "tag": "ab", "on": True,
        "big": 2**64 - 1, "u": 2**32 - 1, "i": -9, "c": "q",
    }
    want = {(f"p/{k}", 4): x for k, x in leaves.items()} | {("p/x", 4): 1.5}
    for i, x in ((0, 1.0), (1, 2.0)):
        want |= {(f"q/{i}/{k}", 6): y for k, y in leaves.items()} | {(f"q/{i}/x", 6): x}
    want |= {("q/length", 6): 2, ("q/length", 7): 0}
    assert v == want
    types = {r.key: r.vtype for r in got.entries.filter("ts = 4").collect()}
    assert types["p/mode"] == "int8" and types["p/on"] == "boolean" and types["p/y"] == "float"
    assert reasons(got.quarantine) == [
        (4, "struct", "too few bytes for a struct"),
        (8, "struct", "trailing partial element"),
    ]
    fields = [(r.pos, r.field, r.type, r["count"], r.enum) for r in got.schema_fields.orderBy("pos").collect()]
    assert fields[2] == (2, "mode", "int8", None, {"a": 1, "b": -2})
    assert fields[3] == (3, "w", "uint16", 2, None)
    offsets = {r.leaf_path: (r.offset, r.struct_size) for r in got.struct_layout.collect()}
    assert offsets["c"] == (struct.calcsize(POSE_FORMAT) - 1, struct.calcsize(POSE_FORMAT))


def schema(entry, name, body, ts=0):
    return start(entry, f".schema/struct:{name}", "structschema") + rec(entry, ts, body.encode())


def test_nested_structs(spark):
    parts = [
        schema(1, "In", "int8 a; int16 b[2]"),
        schema(2, "Out", "In one; In many[2]; int8 z; struct_like s"),
        start(13, "struct_like", "structschema"), rec(13, 0, b"int8 t"),
        start(3, "o", "struct:Out"),
        rec(3, 1, struct.pack("<bhh bhh bhh b b", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)),
        schema(4, "Loop", "int8 v; Loop next"),
        start(5, "l", "struct:Loop"), rec(5, 1, b"\x01"),
        schema(6, "Bits", "int8 v; int8 w : 4; int8 x"),
        start(7, "bits", "struct:Bits"), rec(7, 1, b"\x01\x02"),
        schema(8, "Empty", ""),
        start(9, "e", "struct:Empty[]"), rec(9, 1, b"\x01"),
        start(10, "e1", "struct:Empty"), rec(10, 1, b""),
    ]
    got = ingest(spark, a=log(*parts))
    assert values(got) == {
        ("o/one/a", 1): 1, ("o/one/b/length", 1): 2, ("o/one/b/0", 1): 2, ("o/one/b/1", 1): 3,
        ("o/many/length", 1): 2,
        ("o/many/0/a", 1): 4, ("o/many/0/b/length", 1): 2, ("o/many/0/b/0", 1): 5, ("o/many/0/b/1", 1): 6,
        ("o/many/1/a", 1): 7, ("o/many/1/b/length", 1): 2, ("o/many/1/b/0", 1): 8, ("o/many/1/b/1", 1): 9,
        ("o/z", 1): 10, ("o/s/t", 1): 11,
    }
    assert sorted(r.reason for r in got.quarantine.collect()) == [
        "incomplete schema", "recursive struct", "zero-size struct array",
    ]


def test_deferred_rows_and_schema_versions(spark):
    parts = [
        start(1, "v", "struct:A"),
        rec(1, 1, b"\x01\x02"),  # seq 1: waits for A
        schema(2, "A", "B inner"),  # seq 3: B is still missing
        rec(1, 2, b"\x03\x04"),  # seq 4: waits for B
        start(9, "v/inner/x", "int64"),
        rec(9, 1, i64(99)),  # seq 6: written before seq 1 is released, so it loses
        schema(3, "B", "int8 x"),  # seq 8 completes A
        rec(1, 3, b"\x05\x06"),
        rec(3, 0, b"int8 x; int8 y"),  # seq 10: new layout for later records only
        rec(1, 4, b"\x07\x08"),
        start(4, "w", "struct:Never"),
        rec(4, 1, b"\x00"),
        schema(5, "C", "Gone g"),
        start(6, "c", "struct:C"),
        rec(6, 1, b"\x00"),
    ]
    got = ingest(spark, a=log(*parts))
    assert values(got) == {
        ("v/inner/x", 1): 1, ("v/inner/x", 2): 3, ("v/inner/x", 3): 5,
        ("v/inner/x", 4): 7, ("v/inner/y", 4): 8,
    }
    assert {(r.missing_struct, r.key) for r in got.unresolved.collect()} == {
        ("struct:Never", "w"), ("Gone", "c"),
    }
    order = {(r.key, r.ts): (r.ord.eff, r.ord.seq) for r in got.entries.collect()}
    assert order[("v/inner/x", 1)] == (8, 1)


def entity_log():
    return log(
        start(1, "arm/.type", "string"), rec(1, 0, b"Entity"),
        start(2, "arm/.components", "string"), rec(2, 0, b"Scalar"),
        start(3, "arm/Scalar", "int64"), rec(3, 10, i64(4)), rec(3, 20, i64(5)),
        start(4, "arm/note", "string"), rec(4, 15, b"x"), rec(4, 20, b"y"),
        start(5, "leg/.type", "string"), rec(5, 0, b"Entity"),
        start(6, "leg/.components/0", "string"), rec(6, 0, b"Point3d"),
        start(7, "leg/.components/1", "string"), rec(7, 0, b"Wheel"),
        start(8, "leg/Point3d/x", "double"), rec(8, 1, f64(1)), rec(8, 9, f64(1.5)),
        start(9, "leg/Point3d/y", "double"), rec(9, 2, f64(2)),
        start(10, "leg/Point3d/z", "double"), rec(10, 3, f64(3)),
        start(11, "leg/go", "boolean"), rec(11, 2, b"\x01"), rec(11, 5, b"\x01"),
        start(12, "rock/.type", "string"), rec(12, 0, b"Thing"),
        start(13, "rock/.components", "string"), rec(13, 0, b"Scalar"),
        start(14, "rock/Scalar", "double"), rec(14, 1, f64(1)),
    )


@pytest.mark.parametrize("min_rows", [1_000_000, 2])
def test_entities(spark, min_rows):
    got = ingest(spark, {"min_rows": min_rows}, a=entity_log())
    rows = sorted(
        (r.entity, r.ts, r.component, r.scalar, tuple(r.point3d or ()), r.n_triggers) for r in got.entity_rows.collect()
    )
    assert rows == [
        ("arm", 10, "Scalar", 4.0, (), 1),
        ("arm", 15, "Scalar", 4.0, (), 1),
        ("arm", 20, "Scalar", 5.0, (), 2),
        ("leg", 5, "Point3d", None, (1.0, 2.0, 3.0), 1),
    ]
    bad = sorted((r.key, r.ts, r.reason) for r in got.quarantine.collect())
    assert bad == [
        ("arm/Scalar", 0, "no value"),
        ("leg/Point3d", 0, "no value for x"),
        ("leg/Point3d", 2, "no value for z"),
        ("leg/Wheel", 0, "unknown component"),
        ("leg/Wheel", 2, "unknown component"),
        ("leg/Wheel", 5, "unknown component"),
    ]
    sub = ingest(spark, {"min_rows": min_rows, "trigger": "subtree"}, a=entity_log()).entity_rows
    points = sorted((r.ts, tuple(r.point3d)) for r in sub.filter("component = 'Point3d'").collect())
    assert points == [(3, (1.0, 2.0, 3.0)), (5, (1.0, 2.0, 3.0)), (9, (1.5, 2.0, 3.0))]
