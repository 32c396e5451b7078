"""Paths that only large or skewed data takes, forced with small limits and compared with
brute force or with the ordinary path."""

import random

import numpy as np
import pytest
from logs import f64, log, rec, start
from pyspark.sql import functions as F

from tracklake.operators import collisions, lookup, ordered
from tracklake.operators.context import attach_context, entry_defs
from tracklake.operators.entries import overlapping
from tracklake.plans.ingest import Ingest, ingest_path
from tracklake.session import staging_path
from tracklake.sources import logfiles, ranges
from tracklake.sources.control import decode_records
from tracklake.sources.framing import scan_frames, walk
from tracklake.sources.ranges import large_logs, scan_ranges
from tracklake.testkit.files import write_files


def skewed(seed, n=600):
    """A third of the rows under one key, with times of their own."""
    rng = random.Random(seed)
    times = rng.sample(range(10 * n), n)
    return [("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", t, rng.random() < 0.3) for t in times]


@pytest.mark.parametrize("min_rows", [10, 60, 1_000_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_fill_forward_with_hot_groups(spark, min_rows, inclusive):
    rows = skewed(1)
    df = spark.createDataFrame(rows, "k string, t bigint, set boolean")
    got = ordered.fill_forward(
        df, ["k"], ["t"], {"last": F.when(F.col("set"), F.col("t"))}, inclusive=inclusive, min_rows=min_rows
    ).collect()
    want = set()
    for k, t, _ in rows:
        before = [u for j, u, s in rows if j == k and s and (u <= t if inclusive else u < t)]
        want.add((k, t, max(before, default=None)))
    assert {(r.k, r.t, r["last"]) for r in got} == want and len(got) == len(rows)


def test_hot_groups_are_really_split(spark):
    df = spark.createDataFrame(skewed(2), "k string, t bigint, set boolean")
    placed, split = ordered.with_bucket(df, ["k"], "t", min_rows=50)
    assert split
    sizes = {(r.k, r._bucket): r["count"] for r in placed.groupBy("k", "_bucket").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 3 and max(hot) < 0.6 * sum(hot)
    assert all(b == 0 for k, b in sizes if k != "hot")


@pytest.mark.parametrize("min_rows", [10, 1_000_000])
def test_asof_join(spark, min_rows):
    left = [(k, t, i) for i, (k, t, s) in enumerate(skewed(3)) if not s]
    right = [(k, t, None if t % 5 == 0 else t * 1.5) for k, t, s in skewed(4)]
    got = ordered.asof_join(
        spark.createDataFrame(left, "k string, t bigint, i int"),
        spark.createDataFrame(right, "k string, t bigint, v double"),
        ["k"], "t", min_rows=min_rows,
    ).collect()
    assert len(got) == len(left)
    for r in got:
        hits = [(t, v) for k, t, v in right if k == r.k and t <= r.t]
        assert (None if r.match is None else (r.match.t, r.match.v)) == max(hits, default=None, key=lambda h: h[0])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_equals_broadcast(spark, how):
    big = spark.createDataFrame(skewed(5), "k string, t bigint, set boolean")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, v int")
    plain = sorted(map(tuple, lookup.lookup_join(big, small, ["k"], how).collect()))
    salted = sorted(map(tuple, lookup.lookup_join(big, small, ["k"], how, max_bytes=0, min_rows=20).collect()))
    assert plain == salted


def test_context_by_window_equals_interval_join(spark):
    parts = []
    rng = random.Random(6)
    for i in range(200):
        entry = rng.randrange(1, 4)
        parts.append(start(entry, f"n{i}", "double") if rng.random() < 0.2 else rec(entry, i, f64(i)))
    made = spark.createDataFrame([("a", bytearray(log(*parts)))], "recording string, content binary")
    records = Ingest(made.withColumn("path", F.lit("a"))).records
    key = lambda df: {(r.seq, r.ctx and r.ctx.key) for r in df.collect()}
    parts = records.filter("kind = 'raw'"), records.filter("kind <> 'raw'")
    joined = key(attach_context(*parts))
    assert joined == key(attach_context(*parts, max_versions=0))
    assert joined == key(attach_context(*parts, max_bytes=0, max_versions=0, min_rows=10))
    plain, split = (sorted(map(str, entry_defs(records, n).collect())) for n in (1_000_000, 5))
    assert plain == split


def random_log(seed, n=400, torn=False):
    rng = random.Random(seed)
    parts = [start(i, f"NT:/k/{i}", "raw") for i in range(1, 5)]
    for i in range(n):
        size = rng.choice([0, 3, 8, 40, 700])
        parts.append(rec(rng.randrange(1, 5), i * 7, rng.randbytes(size)))
    whole = log(*parts)
    return whole[:-5] if torn and len(parts[-1]) > 5 else whole


@pytest.mark.parametrize("seed, torn", [(1, False), (2, True)])
def test_ranges_equal_whole_files(spark, seed, torn):
    folder = staging_path(spark, "range-test")
    rows = [("x.wpilog", bytearray(random_log(seed, torn=torn))), ("bad.wpilog", bytearray(b"WPILOG\x00\x02"))]
    write_files(spark.createDataFrame(rows, "path string, content binary"), folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    files = logfiles.list_files(spark, folder).withColumn("recording", name)
    text = lambda df: sorted(map(str, decode_records(df).collect()))
    read = logfiles.read_files(spark, folder).withColumn("recording", name)
    whole = text(scan_frames(logfiles.with_header(read)))
    assert whole == text(scan_ranges(large_logs(files, range_bytes=2500)))


def decoy_log(seed, n=60):
    """A log whose payloads are logs themselves, cut anywhere, so that most guesses are wrong."""
    rng = random.Random(seed)
    parts = [start(1, "k", "raw")]
    for i in range(n):
        inner = b"".join(rec(2, j, rng.randbytes(rng.choice([1, 30, 300]))) for j in range(rng.randrange(1, 60)))
        parts.append(rec(1, i, inner[rng.randrange(9) :]))
    return log(*parts)


@pytest.mark.parametrize("range_bytes", [700, 4000])
def test_entries_in_log_rounds_against_decoys(spark, monkeypatch, range_bytes):
    folder = staging_path(spark, "decoys")
    rows = [(f"{i}.wpilog", bytearray(decoy_log(i))) for i in range(2)] + [("torn.wpilog", bytearray(decoy_log(9)[:-3])), ("plain.wpilog", bytearray(random_log(3)))]
    write_files(spark.createDataFrame(rows, "path string, content binary"), folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    files = logfiles.list_files(spark, folder).withColumn("recording", name)
    written = []
    monkeypatch.setattr(ranges, "stage", lambda df, label, f=ranges.stage: (written.append(label), f(df, label))[1])
    logs = large_logs(files, range_bytes=range_bytes)
    n_ranges = logs.ranges.groupBy("path").count().agg(F.max("count")).first()[0]
    assert written.count("range-maps") == 1 + (n_ranges - 1).bit_length()  # the decoys did mislead the guesses
    text = lambda df: sorted(map(str, decode_records(df).collect()))
    whole = text(scan_frames(logfiles.with_header(logfiles.read_files(spark, folder).withColumn("recording", name))))
    assert text(scan_ranges(logs)) == whole


def test_only_entries_that_maps_lead_to_are_composed(spark, monkeypatch):
    """The rounds hold few places a range, not all at which some byte, read as a record, could end."""
    folder = staging_path(spark, "composed")
    write_files(spark.createDataFrame([(f"{i}.wpilog", bytearray(decoy_log(i))) for i in range(2)], "path string, content binary"), folder)
    files = logfiles.list_files(spark, folder).withColumn("recording", F.regexp_extract("path", r"([^/]*)$", 1))
    made = {}
    monkeypatch.setattr(ranges, "stage", lambda df, label, f=ranges.stage: made.setdefault(label, []).append(f(df, label)) or made[label][-1])
    large_logs(files, range_bytes=4000)
    possible, rounds = made["range-links"][0].count(), [x.count() for x in made["range-maps"]]
    assert 0 < max(rounds) < possible / 4, (possible, rounds)


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 16])
def test_exits_and_maps_of_a_range(tmp_path, window):
    rng = random.Random(window)
    body = bytes(rng.choice([0, 1, 2, 3, 5, 40, 127, 200]) for _ in range(900)) + decoy_log(1, 8)[12:]
    path = tmp_path / "x"
    path.write_bytes(body)
    row = {"path": f"file:{path}", "length": len(body), "lo": 100, "hi": 1100}

    def leave(at, hi):
        while at < hi:
            starts, after = walk(memoryview(body), at, hi, len(body))
            if after == at:
                return -1
            at = after
        return at

    nodes = np.arange(100, 1100)
    want = [leave(int(p), 1100) for p in nodes]
    assert ranges.map_of_range(row, nodes, window).tolist() == want
    some = np.array(sorted(rng.sample(range(100, 1100), 30)))
    assert ranges.map_of_range(row, some, window).tolist() == [want[p - 100] for p in some]
    direct = {walk(memoryview(body), int(p), int(p) + 1, len(body))[1] for p in nodes}
    assert ranges.exits_of_range(row).tolist() == sorted(p for p in direct if 1100 <= p < len(body))


def test_foreign_and_empty_files_are_skipped(spark):
    folder = staging_path(spark, "foreign")
    rows = [
        ("a.wpilog", bytearray(log(start(1, "k", "double"), rec(1, 5, f64(2))))),
        ("b.wpilog", bytearray(b"")),
        ("c.wpilog", bytearray(b"PNG....")),
        ("d.txt", bytearray(log())),
    ]
    write_files(spark.createDataFrame(rows, "path string, content binary"), folder)
    got = ingest_path(spark, folder, application_id="app")
    assert [(r.extra_header, r.application_id, r.store_source, r.name) for r in got.recordings.collect()] == [
        ("", "app", "WpiLog", "WpiLog")
    ]
    assert [(r.key, r.ts, r.v_double) for r in got.entries.collect()] == [("k", 5, 2.0)]
    assert got.quarantine.count() == 0


@pytest.mark.parametrize("unit_rows", [1, 7, 100, 1 << 21])
@pytest.mark.parametrize("in_order", [True, False])
def test_repeated_keys_whatever_the_units(spark, unit_rows, in_order):
    rng = random.Random(unit_rows)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([None, *range(300)])) for _ in range(400)]
    rows += [("hot", "z", t) for t in range(500)] + [("hot", "z", 77)] * 3
    rows.sort(key=lambda r: (r[2] is not None, r[2] or 0)) if in_order else rng.shuffle(rows)
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 5), "r string, k string, t bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 9)
    try:
        got, n = collisions.repeated(df, ["r", "k"], "t", unit_rows, min_rows=50)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {r for r in rows if rows.count(r) > 1}
    assert {tuple(r) for r in got.collect()} == want and n == len(want) == got.count()


def test_only_suspects_are_counted(spark):
    """Of keys in order of time, split over units, only the repeated and the ends of units are suspects."""
    rows = [("r", f"k{i % 3}", i) for i in range(3000)] + [("r", "k0", 2997)] * 2
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "r string, k string, t bigint")
    assert collisions.suspects(df.filter("t < 2997"), ["r", "k"], "t") is None
    assert collisions.suspects(df, ["r", "k"], "t").count() == 3
    assert collisions.suspects(df.limit(0), ["r", "k"], "t") is None
    assert collisions.repeated(df.limit(0), ["r", "k"], "t")[1] == 0


def test_a_unit_holds_half_a_million_rows():
    """A task holds one unit and some copies of it, whatever its share of the rows is."""
    import numpy as np
    import pyarrow as pa

    def batches():
        for lo in range(0, 1_000_000, 10_000):
            at = pa.array(np.arange(lo, lo + 10_000))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(10_000, np.int64)), at, at], names=["_group", "_at", "_write"])

    spans = [r for b in collisions._units(collisions.UNIT_ROWS)(batches()) for r in b.to_pylist() if r["twice"] is None]
    assert len(spans) >= 2 and max(r["last"] - r["first"] for r in spans) < 600_000
    assert (spans[0]["first"], spans[-1]["last"]) == (0, 999_999)


def test_names_that_may_meet_whatever_their_repeats(spark):
    """Against brute force, from a row per record; where no compound entry stands above another one, no name is joined or shuffled."""
    rng = random.Random(12)
    names = ["", "/", "a", "a/b", "a//b", "/a", "a/b/c", "a/b/c/d", "b", "b/1", "b/1/x", "c", "c/"]
    rows = [(rng.choice("rs"), k, k in ("a/b", "b", "", "c/") and rng.random() < 0.5) for k in names for _ in range(4)]
    above = lambda k: [("/".join(k.split("/")[:n])) for n in range(len(k.split("/")))]
    pairs = {(r, low, up) for r, low, _ in rows for r2, up, many in rows if r == r2 and many and up in above(low) and up != low}
    df = spark.createDataFrame(rows, "recording string, key string, compound boolean")
    got = [tuple(r) for r in overlapping(df).collect()]
    assert set(got) == {(r, k) for r, low, up in pairs for k in (low, up)} and len(got) == len(set(got)) > 6
    alone = overlapping(spark.createDataFrame([("r", f"order/{i % 50}", True) for i in range(200)], df.schema))
    plan = alone._jdf.queryExecution().optimizedPlan().toString()
    assert alone.isEmpty() and "Join" not in plan and "Aggregate" not in plan
