"""Sinks, streaming, wide structs, odd schemas, paths, and a session without any configuration."""

import os
import random
import struct
import subprocess
import sys

import pytest
from logs import f64, i64, log, rec, start
from pyspark.sql import functions as F

from tracklake.operators import entities, entries, wide
from tracklake.plans.ingest import ingest_contents, ingest_path
from tracklake.session import staging_path
from tracklake.sources.logfiles import list_files
from tracklake.sources.ranges import large_logs, scan_ranges
from tracklake.sources.tables import write_tables
from tracklake.streaming.live import ingest_stream


def contents(spark, **logs):
    made = spark.createDataFrame([(n, bytearray(b)) for n, b in logs.items()], "path string, content binary")
    return ingest_contents(made, F.col("path"))


def schema(entry, name, body):
    return start(entry, f".schema/struct:{name}", "structschema") + rec(entry, 0, body.encode())


def test_runs_without_a_configuration_folder(tmp_path):
    code = "from tracklake.session import *; s = local_session('2', 2, '1g'); print('ROWS', stage(s.range(7), 'x').count())"
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CONF_DIR"} | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)
    assert "ROWS 7" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("shape_bytes", [8 << 20, 0])
def test_wide_structs_over_versions_arrays_and_elements(spark, monkeypatch, shape_bytes):
    monkeypatch.setattr(wide, "SHAPE_BYTES", shape_bytes)
    p = "int16 w[2]; char tag[3]; In in", "In", "float y"
    body = struct.pack("<2h3sf", 5, -6, b"ab\x00", 0.5)
    got = contents(
        spark,
        a=log(schema(1, "P", "double x; " + p[0]), schema(2, p[1], p[2]), start(3, "k", "struct:P"), rec(3, 1, f64(1.5) + body), rec(3, 2, f64(2.5) + body), rec(3, 2, f64(3.5) + body)),
        b=log(schema(1, "P", "int64 x"), start(3, "k", "struct:P[]"), rec(3, 1, i64(7) + i64(8)), schema(4, "Q", "int64 x"), start(5, "q", "struct:Q"), rec(5, 1, i64(9))),
    )
    rows = wide.wide_structs(got.with_layout, got.layouts, "struct:P")
    found = {(r["recording"], r["key"], r["ts"]): r["value"].asDict() for r in rows.collect()}
    assert found == {
        ("a", "k", 1): {"in/y": 0.5, "tag": "ab", "w": [5, -6], "x": 1.5},
        ("a", "k", 2): {"in/y": 0.5, "tag": "ab", "w": [5, -6], "x": 3.5},
        ("b", "k/0", 1): {"in/y": None, "tag": None, "w": None, "x": 7.0},
        ("b", "k/1", 1): {"in/y": None, "tag": None, "w": None, "x": 8.0},
    }
    assert wide.wide_type({"int8", "uint64"}) == "decimal(20,0)" and wide.wide_type({"char", "int8"}) == "string"


@pytest.mark.parametrize("slice_bytes", [16 << 20, 40])
def test_wide_fields_by_matrix_equal_those_by_expression(spark, monkeypatch, slice_bytes):
    """Every primitive, arrays, arrays of structs, bad text and surplus bytes, two versions and a field that turns real."""
    kinds = {"bool": "?", "int8": "b", "int16": "h", "int32": "i", "int64": "q", "uint8": "B", "uint16": "H", "uint32": "I", "uint64": "Q", "float": "f", "double": "d"}
    text = "; ".join(f"{k} {k}; {k} {k}s[3]" for k in kinds) + "; char tag[5]; In m[2]; int32 turns"
    form = "<" + "".join(f"{c}3{c}" for c in kinds.values()) + "5s" + "h3s2b" * 2
    rng = random.Random(5)
    number = lambda c: rng.random() < 0.5 if c == "?" else rng.uniform(-9, 9) if c in "fd" else rng.randrange(*((0, 256**struct.calcsize(c)) if c.isupper() else (-(256**struct.calcsize(c)) // 2, 256**struct.calcsize(c) // 2)))
    bodies = [struct.pack(form, *(number(c) for c in kinds.values() for _ in range(4)), rng.choice([b"ab", b"\xff\xc3\x28", b"\xe2\x82"]), *(x for _ in range(2) for x in (rng.randrange(-99, 99), rng.choice([b"xyz", b"\x80"]), 1, -2))) for _ in range(5)]
    inner = schema(1, "In", "int16 a; char t[3]; int8 b[2]")
    got = contents(
        spark,
        a=log(inner, schema(2, "P", text), start(3, "k", "struct:P"), *(rec(3, t, b + struct.pack("<i", t) + bytes(t)) for t, b in enumerate(bodies))),
        b=log(inner, schema(2, "P", "double turns; In m[2]"), start(3, "k", "struct:P[]"), rec(3, 9, (f64(0.25) + struct.pack("<" + "h3s2b" * 2, 1, b"q", 2, 3, 4, b"r", 5, 6)) * 2)),
    )
    monkeypatch.setattr(wide, "SLICE_BYTES", slice_bytes)
    found = []
    for limit in (8 << 20, 0):
        monkeypatch.setattr(wide, "SHAPE_BYTES", limit)
        rows = wide.wide_structs(got.with_layout, got.layouts, "struct:P")
        found.append((rows.schema["value"].dataType.simpleString(), sorted((r.recording, r.key, r.ts, repr(r.value)) for r in rows.collect())))
    assert found[0] == found[1] and len(found[0][1]) == 7


def test_a_layout_too_large_spoils_only_its_own_records(spark):
    got = contents(
        spark,
        a=log(schema(1, "Big", "int8 x[3000000000]"), start(2, "b", "struct:Big"), rec(2, 1, b"x"), schema(3, "Vast", "double x[9223372036854775807]"), start(4, "v", "struct:Vast"), rec(4, 1, b"x")),
        b=log(start(1, "i", "int64"), rec(1, 1, i64(4)), schema(3, "Ok", "int8 x"), start(4, "o", "struct:Ok"), rec(4, 1, b"\x03")),
    )
    assert {(r["recording"], r["key"], r["v_long"]) for r in got.entries.select("recording", "key", "v_long").collect() if r["v_long"]} == {("b", "i", 4), ("b", "o/x", 3)}
    problems = {(r["recording"], r["key"], r["reason"]) for r in got.quarantine.collect()}
    assert {("a", "b", "layout too large"), ("a", "v", "layout too large")} == problems
    assert got.schema_fields.filter("struct_name = 'struct:Big'").first()["count"] == 3_000_000_000


def test_structs_nest_deeper_than_sixteen(spark):
    chain = [schema(i + 1, f"S{i}", f"S{i + 1} n" if i < 17 else "int8 x") for i in range(18)]
    got = contents(spark, a=log(*chain, start(40, "d", "struct:S0"), rec(40, 1, b"\x05")))
    assert [(r["key"], r["v_long"]) for r in got.entries.collect()] == [("d/" + "n/" * 17 + "x", 5)]


def test_chunks_follow_time_not_size(spark):
    rows = spark.createDataFrame([("a", "e", t, "Scalar", 1.0, None, 1) for t in range(40)], "recording string, entity string, ts long, component string, scalar double, point3d array<float>, n_triggers int")
    assert [r["n_rows"] for r in entities.entity_chunks(rows).collect()] == [40]
    assert sorted((r["chunk"], r["n_rows"]) for r in entities.entity_chunks(rows, 15).collect()) == [(0, 15), (1, 15), (2, 10)]
    assert [r["n_rows"] for r in entities.entity_chunks(rows, None).collect()] == [40]


def test_a_rerun_leaves_no_stale_rows(spark):
    out = staging_path(spark, "tables")
    bad, good = log(start(1, "i", "int64"), rec(1, 1, b"x"), rec(1, 2, i64(3))), log(start(1, "i", "int64"), rec(1, 2, i64(3)))
    write_tables(contents(spark, **{"a b=c": bad, "z": bad}), out, 0)
    assert spark.read.parquet(f"{out}/quarantine").count() == 2
    write_tables(contents(spark, **{"a b=c": good}), out, 0)
    assert [r["recording"] for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["z"]
    assert spark.read.parquet(f"{out}/entries").count() == 2
    assert spark.read.parquet(f"{out}/changes").count() == 1
    assert spark.read.parquet(f"{out}/entry_defs").count() == 2


def test_streamed_batches_equal_one_batch_and_replay(spark, tmp_path):
    source, out, check = tmp_path / "in put", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    logs = {f"f{i}": log(schema(9, "P", "int8 a"), start(8, "p", "struct:P"), rec(8, 1, bytes([i])), start(1, f"k{i}", "int64"), rec(1, i, i64(i)), rec(7, 3, b"")) for i in range(4)}
    for turn in (("f0", "f1"), ("f2", "f3")):
        for name in turn:
            (source / f"{name}.wpilog").write_bytes(logs[name])
        ingest_stream(spark, str(source), out, check).awaitTermination()
    whole = ingest_path(spark, str(source))
    write_tables(whole, str(tmp_path / "batch"))
    for name in ("recordings", "records", "entry_defs", "schema_fields", "struct_layout", "entries", "quarantine"):
        streamed, batch = (spark.read.parquet(f"{d}/{name}") for d in (out, str(tmp_path / "batch")))
        assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.select(streamed.columns).collect())), name
    changes = {r["batch_id"]: r["count"] for r in spark.read.parquet(f"{out}/changes").groupBy("batch_id").count().collect()}
    assert changes == {0: 4, 1: 4}
    assert entries.change_set(whole.entries).count() == 8


def test_ranges_read_odd_paths_and_keep_torn_tails(spark, tmp_path):
    folder = tmp_path / "odd %41 name"
    folder.mkdir()
    data = log(start(1, "i", "int64"), *[rec(1, i, i64(i)) for i in range(200)]) + rec(1, 1, b"y" * 50)[:-7]
    (folder / "a b#c.wpilog").write_bytes(data)
    files = list_files(spark, str(folder)).withColumn("recording", F.lit("r"))
    ranged = scan_ranges(large_logs(files, range_bytes=512))
    whole = ingest_path(spark, str(folder))
    torn = ranged.filter("issue is not null").collect()
    assert [bytes(r["data"]) for r in torn] == [bytes(r["data"]) for r in whole.decoded.filter("part = 'problem'").collect()] and len(torn) == 1
    key = lambda df: sorted((r["seq"], r["entry_id"], r["ts"], bytes(r["data"])) for r in df.collect())
    assert key(ranged.filter("entry_id > 0 and issue is null")) == key(whole.records.filter("kind = 'raw'"))


def test_partitioned_tables_are_written_unsorted(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tracklake.session import stage

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(int(spark.conf.get(name, "0"))), write(self, path)))
    rows = spark.range(0, 1000, 1, 3).selectExpr("id", "concat('p', id % 4) AS part")
    got = stage(rows, "parts", "part")
    assert seen[0] >= 4 and spark.conf.get(name, None) == before
    assert sorted(map(tuple, got.collect())) == [(i, f"p{i % 4}") for i in range(1000)]
    assert len({r[0].split("part=")[1].split("/")[0] for r in got.selectExpr("input_file_name()").collect()}) == 4
    many = stage(spark.range(0, 100, 1, 1).selectExpr("id", "id % 40 AS part"), "many", "part")  # more than may be open
    assert sorted(r.id for r in many.collect() if r.part == r.id % 40) == list(range(100))


def test_recordings_are_looked_up_only_where_any_is_stored(spark, tmp_path, monkeypatch):
    from tracklake.sources.tables import remove_recordings

    path, looked = str(tmp_path / "t"), []
    names = spark.createDataFrame([("a b=c",), ("d",)], "recording string")
    nothing = names.limit(0)
    nothing.selectExpr("1 AS v", "recording").write.partitionBy("recording").parquet(path)
    real = type(names).toLocalIterator
    monkeypatch.setattr(type(names), "toLocalIterator", lambda self, *a: (looked.append(1), real(self, *a))[1])
    remove_recordings(nothing, path, names)
    assert not looked
    names.selectExpr("1 AS v", "recording").write.mode("append").partitionBy("recording").parquet(path)
    remove_recordings(names.filter("recording = 'd'"), path, names)
    assert looked and [r.recording for r in spark.read.parquet(path).collect()] == ["d"]


def test_only_repeated_wide_structs_are_shuffled(spark):
    """The last write wins among records and elements of arrays; without repeats nothing is aggregated."""
    once = [rec(3, t, i64(t)) for t in range(5)]
    got = contents(
        spark,
        a=log(schema(1, "P", "int64 x"), start(3, "k", "struct:P"), *once),
        b=log(schema(1, "P", "int64 x"), start(3, "k", "struct:P[]"), start(4, "k/1", "struct:P"), rec(3, 1, i64(7) + i64(8)), rec(4, 1, i64(9)), rec(4, 2, i64(5)), rec(4, 2, i64(6))),
    )
    rows = wide.wide_structs(got.with_layout, got.layouts, "struct:P")
    found = sorted((r["recording"], r["key"], r["ts"], r["value"]["x"]) for r in rows.collect())
    assert found == [("a", "k", t, t) for t in range(5)] + [("b", "k/0", 1, 7), ("b", "k/1", 1, 9), ("b", "k/1", 2, 6)]
    alone = wide.wide_structs(got.with_layout.filter("recording = 'a'"), got.layouts, "struct:P")
    assert alone.count() == 5 and "max_by" not in alone._jdf.queryExecution().optimizedPlan().toString()
