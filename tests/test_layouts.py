"""Layouts of nested arrays against plain recursion, and elements made only for data that exists."""

import random
import re
import struct

import pytest
from logs import i64, log, rec, start
from pyspark.sql import functions as F
from test_writing import contents, schema

from tracklake.operators import schemas, wide

SIZES = {"int8": 1, "int16": 2, "int32": 4, "double": 8}


def leaves_of(types, name):
    """[(path, prim, offset, count)] and the size of a struct, by making every element."""
    out, at = [], 0
    for field, kind, count in types[name]:
        if kind in SIZES:
            out.append((field, kind, at, count))
            at += SIZES[kind] * (count or 1)
            continue
        inner, size = leaves_of(types, kind)
        for i in range(count or 1):
            prefix = field if count is None else f"{field}/{i}"
            out += [(f"{prefix}/{p}", k, at + i * size + o, c) for p, k, o, c in inner]
        at += size * (count or 1)
    return out, at


def random_types(rng):
    names = [f"S{i}" for i in range(5)]
    types = {}
    for i, name in enumerate(names):
        kinds = [*SIZES, *names[i + 1 :], *names[i + 1 :]]
        types[name] = [(f"f{j}", rng.choice(kinds), rng.choice([None, None, 1, 2, 3])) for j in range(rng.randrange(0 if i else 1, 4))]
    return types


def text_of(fields):
    return "; ".join(f"{kind} {name}" + ("" if count is None else f"[{count}]") for name, kind, count in fields)


def test_offsets_of_nested_arrays(spark):
    rng = random.Random(8)
    types = {f"r{i}": random_types(rng) for i in range(12)}
    got = contents(spark, **{r: log(*(schema(i + 1, n, text_of(f)) for i, (n, f) in enumerate(t.items()))) for r, t in types.items()})
    last = got.layouts.groupBy("recording", "struct_name").agg({"schema_seq": "max"}).collect()
    newest = {(r[0], r[1]): r[2] for r in last}
    found, sizes = {}, {}
    for r in got.struct_layout.collect():
        if newest[r.recording, r.struct_name] == r.schema_seq:
            found.setdefault((r.recording, r.struct_name), set()).add((r.leaf_path, r.prim, r.offset, r["count"]))
            sizes[r.recording, r.struct_name] = r.struct_size
    for recording, kinds in types.items():
        for name in kinds:
            want, size = leaves_of(kinds, name)
            key = recording, f"struct:{name}"
            assert found.get(key, set()) == set(want), (key, kinds)
            assert not want or sizes[key] == size


@pytest.mark.parametrize("spread", [1, 256])
def test_elements_come_from_records(spark, monkeypatch, spread):
    monkeypatch.setattr(schemas, "SPREAD", spread)
    monkeypatch.setattr(schemas, "CHUNK", 3)
    elements = [(i, i * 2, [i * 3, i * 3 + 1]) for i in range(7)]
    body = b"\x05" + b"".join(struct.pack("<bh2h", a, b, *c) for a, b, c in elements) + b"\x06"
    got = contents(spark, a=log(
        schema(1, "In", "int16 b; int16 c[2]"), schema(2, "Mid", "int8 a; In in[1]"), schema(3, "Out", "int8 h; Mid m[7]; int8 t"),
        start(4, "o", "struct:Out"), rec(4, 1, body), rec(4, 2, body[:-1]),
    ))
    values = {r.key: next(v for v in (r.v_long, r.v_double) if v is not None) for r in got.entries.filter("ts = 1").collect()}
    want = {"o/h": 5, "o/t": 6, "o/m/length": 7}
    for i, (a, b, c) in enumerate(elements):
        want |= {f"o/m/{i}/a": a, f"o/m/{i}/in/length": 1, f"o/m/{i}/in/0/b": b, f"o/m/{i}/in/0/c/length": 2, f"o/m/{i}/in/0/c/0": c[0], f"o/m/{i}/in/0/c/1": c[1]}
    assert values == want
    assert [r.reason for r in got.quarantine.collect()] == ["too few bytes for a struct"]
    (row,) = wide.wide_structs(got.with_layout, got.layouts, "struct:Out").collect()
    assert row["value"].asDict() == {
        "h": 5, "t": 6, "m/a": [a for a, *_ in elements], "m/in/b": [b for _, b, _ in elements], "m/in/c": [x for *_, c in elements for x in c],
    }


def test_huge_counts_cost_nothing_and_spoil_nothing_else(spark):
    good = [schema(1, "Ok", "int8 x"), start(2, "o", "struct:Ok"), rec(2, 1, b"\x03"), start(3, "i", "int64"), rec(3, 1, i64(4))]
    vast = [
        schema(1, "In", "int32 a; double b"), schema(2, "Out", "In x[2000000000]"), start(3, "o", "struct:Out"), rec(3, 1, b"x" * 40),
        schema(4, "Legal", "int8 h; In x[100000000]; int8 t"), start(5, "l", "struct:Legal"), rec(5, 2, b"x" * 40),
        schema(6, "Deep", "Legal l[2147483647]"), schema(7, "Deeper", "Deep d[2147483647]; Deep e[2147483647]"), start(8, "d", "struct:Deeper"), rec(8, 3, b"x"),
        start(9, "i", "int64"), rec(9, 1, i64(5)), schema(10, "None", ""), schema(11, "Nones", "None n[2000000000]; int8 x"), start(12, "n", "struct:In"), rec(12, 4, b"y" * 12),
    ]
    got = contents(spark, good=log(*good), vast=log(*vast))
    values = {(r.recording, r.key) for r in got.entries.collect()}
    assert values == {("good", "o/x"), ("good", "i"), ("vast", "i"), ("vast", "n/a"), ("vast", "n/b")}
    assert sorted((r.ts, r.reason) for r in got.quarantine.collect()) == [(1, "layout too large"), (2, "too few bytes for a struct"), (3, "layout too large")]
    sizes = {r.struct_name: (r.problem, r.struct_size if r.problem is None else None, len(r.leaves)) for r in got.layouts.filter("recording = 'vast'").orderBy("schema_seq").collect()}
    assert sizes["struct:Legal"] == (None, 1_200_000_002, 5)
    assert sizes["struct:Out"][0] == sizes["struct:Deep"][0] == sizes["struct:Deeper"][0] == "layout too large"
    assert sizes["struct:Nones"] == (None, 1, 2)


def test_chains_have_a_layout_where_they_are_whole(spark):
    """A chain registered from its head on: not a layout for each registration in between; a type that comes with a second version counts."""
    chain = [schema(i + 1, f"C{i}", "int8 a; " + ("double x" if i == 6 else f"C{i + 1} next")) for i in range(7)]
    late = [schema(1, "A", "int8 a"), schema(2, "B", "A a"), rec(1, 0, b"int8 a; D d"), schema(3, "D", "int16 d")]
    loop = [schema(1, "L", "M m"), schema(2, "M", "L l")]
    got = contents(spark, chain=log(*chain), late=log(*late), loop=log(*loop))
    rows = {(r.recording, r.struct_name.removeprefix("struct:"), r.schema_seq): (r.complete, r.problem, r.struct_size) for r in got.layouts.collect()}
    assert {k[1:]: v for k, v in rows.items() if k[0] == "chain"} == {(f"C{i}", 13): (True, None, 15 - i) for i in range(7)}
    assert {k[1:]: v[0] for k, v in rows.items() if k[0] == "late"} == {
        ("A", 1): True, ("A", 4): False, ("A", 6): True, ("B", 3): True, ("B", 4): False, ("B", 6): True, ("D", 6): True,
    }
    assert {k[1:]: v[1] for k, v in rows.items() if k[0] == "loop"} == {("L", 3): "recursive struct", ("M", 3): "recursive struct"}


def test_fields_without_a_count_are_not_cast(spark):
    """A cast that fails is an exception inside, dearer than the patterns of a field: an empty count is left out before it."""
    odd = spark.createDataFrame([("int8 a[0]; int8 b[99999999999999999999]; int8 c[07]; int8 d",)], "text string")
    parsed = schemas.parse_schema_text(odd)
    assert [f["count"] for f in parsed.first()["fields"]] == [None, None, 7, None]
    cut = F.col("cut")
    plan = odd.select(F.lit("").alias("x")).select(F.struct(*[F.lit(v).alias(k) for k, v in {"ok": True, "rest": "", "field": "a", "type": "t", "count": "", "block": ""}.items()]).alias("cut"))
    text = plan.select(schemas._field(cut).alias("f"))._jdf.queryExecution().analyzed().toString()
    assert re.search(r"CASE WHEN NOT \(cut#\d+\.count = \) THEN try_cast\(cut#\d+\.count as bigint\)", text), text
