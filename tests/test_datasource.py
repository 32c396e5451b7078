"""The data source ``wpilog`` against the ingest plan."""

import random

import pytest
from logs import f64, log, rec, start
from pyspark.sql import functions as F
from test_scale import decoy_log, random_log

from tracklake.plans.ingest import ingest_path
from tracklake.session import staging_path
from tracklake.sources import datasource
from tracklake.testkit.files import write_files


@pytest.fixture(scope="module")
def folder(spark):
    path = staging_path(spark, "source test")
    control = [
        start(1, "a", "double", ts=3), rec(1, 5, f64(1.5)), rec(0, 6, b"\x01\x01\x00\x00\x00"), rec(0, 7, b"\x02\x01\x00\x00\x00\x02\x00\x00\x00hi"),
        rec(0, 8, b""), rec(0, 9, b"\x09\x01\x00\x00\x00"), rec(0, 10, b"\x00\x01\x00\x00\x00\xff\x00\x00\x00"), rec(0, 11, b"\x02\x01\x00\x00\x00\x01\x00\x00\x00\xff"),
        rec(0, 12, b"\x01\x01"), rec(4294967295, 2**63 - 1, b""), rec(2, 2**64 - 1, b"late"), rec(1, 13, f64(2.5)),
    ]
    rows = [("control.wpilog", log(*control)), ("torn.wpilog", decoy_log(4)[:-3]), ("x.wpilog", random_log(5)), ("empty.wpilog", b""), ("other.wpilog", b"PNG..."),
            ("old.wpilog", b"WPILOG\x00\x02\x00\x00\x00\x00"), ("short.wpilog", b"WPILOG\x00\x01\xff"), ("odd name%20.wpilog", random_log(6)), ("skipped.txt", log())]
    write_files(spark.createDataFrame([(n, bytearray(b)) for n, b in rows], "path string, content binary"), path)
    return path


def text(df):
    return sorted(map(str, df.collect()))


def test_source_gives_the_records_of_the_ingest_plan(spark, folder):
    want = text(ingest_path(spark, folder).records)
    datasource.register(spark)
    assert text(spark.read.format("wpilog").load(folder)) == want
    assert text(datasource.read_records(spark, folder, large=3000, range_bytes=2500)) == want
    assert spark.read.format("wpilog").option("pathGlobFilter", "nothing*").load(folder).count() == 0
    with pytest.raises(Exception, match="unusable|truncated"):
        spark.read.format("wpilog").option("mode", "FAILFAST").load(folder).collect()


def test_small_chunks_stream_long_records(monkeypatch, tmp_path):
    rng = random.Random(2)
    body = log(start(1, "a", "raw"), *(rec(1, i, rng.randbytes(rng.choice([1, 50, 5000]))) for i in range(60)))
    (tmp_path / "a.wpilog").write_bytes(body)
    reader = lambda: datasource.LogReader({"path": str(tmp_path)})
    (whole,) = reader().partitions()
    rows = [b.to_pylist() for b in reader().read(whole)]
    monkeypatch.setattr(datasource, "CHUNK_BYTES", 40)
    small = [b.to_pylist() for b in reader().read(whole)]
    assert len(small) > len(rows) and sum(small, []) == sum(rows, [])
    monkeypatch.setattr(datasource, "PACK_BYTES", 10)
    (tmp_path / "b.wpilog").write_bytes(body)
    assert [len(p.pieces) for p in reader().partitions()] == [1, 1]


def test_filters_are_pushed(spark, folder):
    datasource.register(spark)
    rows = spark.read.format("wpilog").load(folder)
    every = ingest_path(spark, folder).records
    name = next(r.recording for r in every.select("recording").distinct().collect() if r.recording.startswith("x-"))
    for condition in (F.col("recording") == name, (F.col("kind") == "raw") & (F.col("ts") >= 5) & (F.col("ts") < 900), F.col("kind").isin("start", "finish"), F.col("entry_id") > 3, F.length("data") > 40):
        assert text(rows.filter(condition)) == text(every.filter(condition))
    plan = rows.filter("kind = 'raw' AND ts > 5 AND length(data) > 4")._jdf.queryExecution().executedPlan().toString()
    (left,) = [line for line in plan.split("\n") if "Filter (" in line]
    assert "data#" in left and "ts#" not in left and "kind#" not in left  # only the last one is left to Spark
    reader = datasource.LogReader({"path": folder})
    assert list(reader.pushFilters([datasource.EqualTo(("recording",), name), datasource.LessThan(("ts",), 7), datasource.EqualTo(("data",), b"")])) == [datasource.EqualTo(("data",), b"")]
    assert [p.recording for part in reader.partitions() for p in part.pieces] == [name]
