"""The driver tables seen as telemetry: log files and keyed records derived with Spark.

Every view covers its whole table. Files hold at most 4,096 events by construction
(``event_id div 4096``), so no file and no group grows with the data, only their number.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions.binary import CODE
from tracklake.plans.ingest import Ingest
from tracklake.session import stage
from tracklake.testkit import encode as E

EVENTS_PER_FILE = 4096
ROBOTS = 16
TYPES = ["click", "error", "purchase", "signup", "view"]
ORIGIN = "TIMESTAMP '2024-01-01 00:00:00'"
_made: dict = {}


def once(build):
    """Build a view once per application and data folder; later queries share the result."""

    @wraps(build)
    def made(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _made:
            _made[key] = build(spark, sf_dir)
        return _made[key]

    return made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their recording, robot, time in µs and place in the file.

    The place is a permutation of the ids in a file (4099 is prime), so that file order
    and time order differ.
    """
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        "props",
        F.expr(f"concat('part-', event_id div {EVENTS_PER_FILE})").alias("recording"),
        F.expr(f"user_id % {ROBOTS}").alias("robot"),
        F.expr("unix_micros(cast(ts as timestamp))" f" - unix_micros(cast({ORIGIN} as timestamp))").alias("t"),
        F.expr("(event_id * 7919) % 4099").alias("pos"),
        (F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("event_type")) - 1).alias("kind_no"),
    )


def _files(frames: DataFrame, extra: Column | None = None) -> DataFrame:
    return stage(_spread(E.log_files(frames, extra), "recording"), "log-files")


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """At least one piece per core: a small table is one Parquet row group and would
    otherwise be read by one task."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


def _data(rows: DataFrame, entry: Column, payload: Column, pos: Column | None = None) -> DataFrame:
    return rows.select(
        "recording",
        (F.col("pos") if pos is None else pos).cast("bigint").alias("pos"),
        E.record(entry, F.col("t"), payload).alias("frame"),
    )


def _starts(rows: DataFrame, entry: Column, name: Column, kind: Column, pos: Column | None = None) -> DataFrame:
    """One Start per distinct definition, by default before all data."""
    pos = entry - 1_000_000 if pos is None else pos
    defs = rows.select(
        "recording", entry.alias("entry"), name.alias("name"), kind.alias("kind"), pos.cast("bigint").alias("pos")
    ).distinct()
    return defs.select(
        "recording",
        "pos",
        E.start(F.col("entry"), F.lit(7), F.col("name"), F.col("kind"), F.lit("{}")).alias("frame"),
    )


def _robot_name(leaf: Column) -> Column:
    return F.concat(F.lit("NT:/robot/"), F.col("robot").cast("string"), F.lit("/"), leaf)


def _event_entry() -> Column:
    return F.col("robot") * 5 + F.col("kind_no") + 1


@once
def value_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """``robot/<r>/<event_type>`` as double: value of every event."""
    ev = events(spark, sf_dir)
    entry = _event_entry()
    frames = _data(ev, entry, E.le_double(F.col("value"))).unionByName(
        _starts(ev, entry, _robot_name(F.col("event_type")), F.lit("double"))
    )
    files = _files(frames, F.concat(F.lit("header of "), F.col("recording")))
    return Ingest(files)


def value_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_logs(spark, sf_dir).files


@once
def restarted_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Per robot: named ``robot/<r>/early`` up to place 2000, then ``robot/<r>/late``, with
    metadata set at the end and a Finish; ``error`` events use an id without a Start."""
    ev = events(spark, sf_dir)
    entry = F.col("robot") + 1
    bad = F.col("event_type") == "error"
    frames = (
        _data(ev, F.when(bad, 1000 + F.col("robot")).otherwise(entry), E.le_double(F.col("value")), F.col("pos") * 200)
        .unionByName(_starts(ev, entry, _robot_name(F.lit("early")), F.lit("double")))
        .unionByName(_starts(ev, entry, _robot_name(F.lit("late")), F.lit("double"), F.lit(400_100) + entry))
    )
    robots = ev.select("recording", "robot").distinct()
    frames = frames.unionByName(
        robots.select(
            "recording",
            (F.lit(10_000_000) + F.col("robot")).alias("pos"),
            E.set_metadata(entry, F.lit(9), F.concat(F.lit("robot "), F.col("robot").cast("string"))).alias("frame"),
        )
    ).unionByName(
        robots.select(
            "recording", (F.lit(20_000_000) + F.col("robot")).alias("pos"), E.finish(entry, F.lit(9)).alias("frame")
        )
    )
    return Ingest(_files(frames))


HOUR = 3_600_000_000


@once
def shared_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Writes that meet, their times cut to the hour: ``view`` has two ids of one name, the id of ``click`` is named
    ``later`` from place 2000 on, and ``error`` writes arrays of one element above the scalars ``0`` of ``signup``."""
    ev = events(spark, sf_dir).withColumn("t", F.col("t") - F.col("t") % HOUR)
    entry, kind = _event_entry(), F.col("event_type")
    entry = F.when((kind == "view") & (F.col("event_id") % 2 == 1), 500 + F.col("robot")).otherwise(entry)
    name = F.concat(F.lit("NT:/robot/"), F.col("robot").cast("string"))
    leaf = F.when(kind == "signup", "0").otherwise(kind)
    name = F.when(kind == "error", name).otherwise(F.concat(name, F.lit("/"), leaf))
    again = _starts(ev.filter(kind == "click"), entry, _robot_name(F.lit("later")), F.lit("double"), F.lit(399_801) + F.col("robot"))
    frames = _data(ev, entry, E.le_double(F.col("value")), F.col("pos") * 200).unionByName(again)
    return Ingest(_files(frames.unionByName(_starts(ev, entry, name, F.when(kind == "error", "double[]").otherwise("double")))))


FIELDS = {  # leaf -> (type, payload)
    "id": ("int64", lambda: E.le_int(F.col("event_id"), 8)),
    "high": ("boolean", lambda: E.le_int((F.col("value") > 50).cast("bigint"), 1)),
    "type": ("string", lambda: F.col("event_type").cast("binary")),
    "props": ("raw", lambda: F.col("props").cast("binary")),
    "single": ("float", lambda: E.le_float(F.col("value").cast("float"))),
    "value": ("double", lambda: E.le_double(F.col("value"))),
}


@once
def typed_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Every event written six times per robot, once per scalar type."""
    ev = events(spark, sf_dir)
    frames = None
    for k, (leaf, (kind, payload)) in enumerate(FIELDS.items()):
        entry = F.col("robot") * 6 + k + 1
        more = _data(ev, entry, payload(), F.col("pos") * 6 + k).unionByName(
            _starts(ev, entry, _robot_name(F.lit(leaf)), F.lit(kind))
        )
        frames = more if frames is None else frames.unionByName(more)
    return Ingest(_files(frames))


MESSES = ["json", "int64", "string[]", "color", "double[]", "struct:Missing", "double"]


@once
def messy_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Event ``i`` is of mess ``i % 8``: seven types that mostly do not decode, and no Start for the last."""
    ev = events(spark, sf_dir).withColumn("mess", F.expr("event_id % 8"))
    entry = F.col("mess") + 1
    kind = F.element_at(F.array(*[F.lit(m) for m in MESSES]), (F.col("mess") + 1).cast("int"))
    payload = (
        F.when(F.col("mess") == 1, E.le_int(F.col("event_id"), 4))
        .when(F.col("mess") == 4, F.concat(E.le_double(F.col("value")), E.le_int(F.col("event_id"), 4)))
        .when(F.col("mess") == 6, E.le_double(F.col("value")))
        .otherwise(F.col("props").cast("binary"))
    )
    named = ev.filter("mess < 7")
    frames = _data(ev, entry, payload).unionByName(
        _starts(named, entry, F.concat(F.lit("mess/"), F.col("mess").cast("string")), kind)
    )
    return Ingest(_files(frames))


ENTITY_NOTE = "note"


def _text(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("binary")


@once
def entity_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Robots as entities: even ones are typed ``Entity``, odd ones ``Thing``.

    Robots 0, 4, 8, 12 list Scalar in one text; 2, 6, 10, 14 list Point3d and Scalar item
    by item; 14 also names an unknown component. purchase = Scalar, click / view / error =
    Point3d x / y / z, signup = a plain child.
    """
    ev = events(spark, sf_dir)
    leaf = F.element_at(
        F.array(*[F.lit(x) for x in ("Point3d/x", "Point3d/z", SCALAR_LEAF, ENTITY_NOTE, "Point3d/y")]),
        (F.col("kind_no") + 1).cast("int"),
    )
    entry = F.col("robot") * 16 + F.col("kind_no") + 1
    frames = _data(ev, entry, E.le_double(F.col("value"))).unionByName(
        _starts(ev, entry, _robot_name(leaf), F.lit("double"))
    )
    robots = ev.select("recording", "robot").distinct()
    robot = F.col("robot")
    listed = (robot % 4) == 2
    marks = robots.select(
        "recording",
        "robot",
        F.explode(
            F.filter(
                F.array(
                    _mark(6, ".type", F.when(robot % 2 == 0, "Entity").otherwise("Thing")),
                    F.when(~listed, _mark(7, ".components", F.lit("Scalar"))),
                    F.when(listed, _mark(8, ".components/0", F.lit("Point3d"))),
                    F.when(listed, _mark(9, ".components/1", F.lit("Scalar"))),
                    F.when(robot == 14, _mark(10, ".components/2", F.lit("Wheel"))),
                ),
                lambda m: m.isNotNull(),
            )
        ).alias("m"),
        F.lit(0).cast("bigint").alias("t"),
    ).select("recording", "robot", "t", "m.*")
    mark_entry = F.col("robot") * 16 + F.col("no")
    frames = frames.unionByName(_starts(marks, mark_entry, _robot_name(F.col("leaf")), F.lit("string"))).unionByName(
        _data(marks, mark_entry, _text(F.col("word")), mark_entry - 500_000)
    )
    return Ingest(_files(frames))


SCALAR_LEAF = "Scalar"


def _mark(no: int, leaf: str, word: Column) -> Column:
    return F.struct(F.lit(no).cast("bigint").alias("no"), F.lit(leaf).alias("leaf"), word.alias("word"))


@once
def vector_logs(spark: SparkSession, sf_dir: str) -> Ingest:
    """``vec/<vec_id>`` as float[]: every embedding, 256 to a file."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.expr("concat('vec-', vec_id div 256)").alias("recording"),
        F.col("vec_id").alias("t"),
        F.col("vec_id").alias("pos"),
        "vec_id",
        F.col("embedding").cast("array<float>").alias("embedding"),
    )
    entry = F.expr("vec_id % 256 + 1")
    frames = _data(rows, entry, E.le_floats(F.col("embedding"))).unionByName(
        _starts(rows, entry, F.concat(F.lit("vec/"), F.col("vec_id").cast("string")), F.lit("float[]"))
    )
    return Ingest(_files(frames))


def keyed_rows(df: DataFrame) -> DataFrame:
    """Complete the keyed columns for rows (recording, seq, ts, key, entry_type, data)."""
    from tracklake.functions.paths import base_type, is_array_type

    kind = F.col("entry_type")
    return df.select(
        "recording",
        F.col("seq").cast("bigint").alias("seq"),
        F.col("ts").cast("bigint").alias("ts"),
        F.lit(1).cast("bigint").alias("entry_id"),
        "key",
        "entry_type",
        base_type(kind).alias("base_type"),
        is_array_type(kind).alias("is_array"),
        F.col("data").cast("binary").alias("data"),
    )


def keyed_ingest(df: DataFrame) -> Ingest:
    """The writes of a key stay together, as they do in a log."""
    return Ingest(None, keyed_rows=stage(_spread(keyed_rows(df), "recording", "key"), "keyed"))


# a unique time and a unique order for the rows of lineitem, the same in SQL
LINE_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
LINE_TS = f"l_linenumber * 1000000000000000 + l_suppkey * 100000000 + {LINE_CENTS}"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "*",
        F.expr("concat('line-', l_orderkey % 64)").alias("recording"),
        F.expr("1000 + l_orderkey * 8 + l_linenumber").alias("seq"),
        F.expr(LINE_TS).alias("ts"),
        F.expr("concat('order/', l_orderkey)").alias("key"),
    )


def _schema_rows(rows: DataFrame, name: str, text: str, seq: int, only: Column | None = None) -> DataFrame:
    """One schema record per recording of ``rows``."""
    where = rows if only is None else rows.filter(only)
    return where.select("recording").distinct().select(
        "recording",
        F.lit(seq).alias("seq"),
        F.lit(0).alias("ts"),
        F.lit(f".schema/struct:{name}").alias("key"),
        F.lit("structschema").alias("entry_type"),
        F.lit(text).cast("binary").alias("data"),
    )


KEYED = ["recording", "seq", "ts", "key", "entry_type", "data"]


@once
def line_structs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Every lineitem as a packed ``struct:Line`` with a nested ``Money``."""
    rows = lines(spark, sf_dir)
    body = F.concat(
        E.le_int(F.col("l_partkey"), 8),
        E.le_int(F.col("l_suppkey"), 4),
        E.le_int(F.col("l_linenumber"), 1),
        E.le_double(F.col("l_extendedprice")),
        E.le_float(F.col("l_tax").cast("float")),
        F.col("l_returnflag").cast("binary"),
        F.rpad(F.col("l_linestatus").cast("binary"), 4, F.lit(b"\x00")),
        E.le_int(F.col("l_quantity").cast("bigint"), 2),
        E.le_int(F.col("l_linenumber") - 4, 2),
        E.le_int((F.col("l_tax") > 0.04).cast("bigint"), 1),
    )
    data = rows.withColumn("entry_type", F.lit("struct:Line")).withColumn("data", body).select(*KEYED)
    line = "int64 part; int32 supp; uint8 line; Money money; char flag; char status[4]; int16 pair[2]; bool taxed"
    return keyed_ingest(
        data.unionByName(_schema_rows(rows, "Line", line, 1)).unionByName(
            _schema_rows(rows, "Money", "double price; float tax", 2)
        )
    )


INT_TYPES = ["int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64"]


@once
def int_structs(spark: SparkSession, sf_dir: str) -> Ingest:
    """``l_linenumber`` in every integer width, negative where signed."""
    rows = lines(spark, sf_dir)
    n = F.col("l_linenumber").cast("bigint")
    body = F.concat(
        E.le_int((n - 4) * 40, 1),
        E.le_int((n - 4) * 9000, 2),
        E.le_int((n - 4) * 600_000_000, 4),
        E.le_int((n - 4) * 2_500_000_000_000_000_000, 8),
        E.le_int(n * 36, 1),
        E.le_int(n * 9000, 2),
        E.le_int(n * 600_000_000, 4),
        E.le_uint64(n.cast("decimal(20,0)") * F.lit(2_500_000_000_000_000_000).cast("decimal(20,0)")),
    )
    text = "; ".join(f"{t} {t}_" for t in INT_TYPES)
    data = rows.withColumn("entry_type", F.lit("struct:Ints")).withColumn("data", body).select(*KEYED)
    return keyed_ingest(data.unionByName(_schema_rows(rows, "Ints", text, 1)))


@once
def array_structs(spark: SparkSession, sf_dir: str) -> Ingest:
    """Every lineitem as an array of ``l_linenumber - 1`` (0 to 6) packed structs."""
    rows = lines(spark, sf_dir)
    many = F.filter(F.sequence(F.lit(0), F.col("l_linenumber") - 1), lambda i: i < F.col("l_linenumber") - 1)
    # the part's bytes are made once per row, not per element
    items = lambda part: F.aggregate(many, F.lit(b""), lambda done, i: F.concat(done, part, E.le_int(i, 2)))
    body = F.transform(F.array(E.le_int(F.col("l_partkey"), 8)), items)[0]
    data = rows.withColumn("entry_type", F.lit("struct:Item[]")).withColumn("data", body).select(*KEYED)
    return keyed_ingest(data.unionByName(_schema_rows(rows, "Item", "int64 part; int16 no", 1)))


LATE_SCHEMA = 50_000


@once
def late_structs(spark: SparkSession, sf_dir: str) -> Ingest:
    """A nested schema completed at ``seq`` 50,000, and never in recordings ``r % 4 = 3``."""
    rows = lines(spark, sf_dir)
    body = E.le_int(F.col("l_partkey"), 4)
    data = rows.withColumn("entry_type", F.lit("struct:Late")).withColumn("data", body).select(*KEYED)
    known = F.expr("cast(substring(recording, 6) as int) % 4 <> 3")
    return keyed_ingest(
        data.unionByName(_schema_rows(rows, "Late", "Inner inner", 3)).unionByName(
            _schema_rows(rows, "Inner", "uint32 part", LATE_SCHEMA, known)
        )
    )


@once
def part_schemas(spark: SparkSession, sf_dir: str) -> Ingest:
    """One schema per part, with its own array sizes, an enum and a shared nested type."""
    rows = table(spark, sf_dir, "part").select(
        F.expr("concat('parts-', p_partkey div 128)").alias("recording"),
        (F.col("p_partkey") + 10).alias("seq"),
        F.lit(0).alias("ts"),
        F.expr("concat('.schema/struct:P', p_partkey)").alias("key"),
        F.lit("structschema").alias("entry_type"),
        F.expr(
            "concat(' Head  head [', p_partkey % 3 + 1, '] ; enum { brand = ', substring(p_brand, 7), ', none=-1 } int8 kind;"
            " char name[', length(p_name), ']; uint16 size;')"
        )
        .cast("binary")
        .alias("data"),
    )
    return keyed_ingest(
        rows.unionByName(_schema_rows(rows, "Head", "double price; Size size", 1)).unionByName(
            _schema_rows(rows, "Size", "int32 w; float h[2]", 2)
        )
    )


CHAIN = 20


def _part_schema(rows: DataFrame, recording: str, text: str) -> DataFrame:
    return rows.select(
        F.expr(recording).alias("recording"),
        (F.col("p_partkey") + 10).alias("seq"),
        F.lit(0).alias("ts"),
        F.expr("concat('.schema/struct:C', p_partkey)").alias("key"),
        F.lit("structschema").alias("entry_type"),
        F.expr(text).cast("binary").alias("data"),
    )


@once
def chained_schemas(spark: SparkSession, sf_dir: str) -> Ingest:
    """One schema per part: a number and the struct of the next part, in chains of ``CHAIN``."""
    last = f"p_partkey % {CHAIN} = {CHAIN - 1}"
    text = f"concat('int8 a; ', if({last}, 'double x', concat('C', p_partkey + 1, ' next')))"
    return keyed_ingest(_part_schema(table(spark, sf_dir, "part"), f"concat('chain-', p_partkey div {CHAIN * 16})", text))


@once
def huge_schemas(spark: SparkSession, sf_dir: str) -> Ingest:
    """One schema per part; every seventh has more elements than any record can hold."""
    text = "concat('int32 a; double x[', if(p_partkey % 7 = 0, 3000000000000000000 + p_partkey, p_size), ']')"
    return keyed_ingest(_part_schema(table(spark, sf_dir, "part"), "concat('huge-', p_partkey div 128)", text))


VAST = "(1000000 + (p_partkey * 7919) % 40000000)"


@once
def vast_schemas(spark: SparkSession, sf_dir: str) -> Ingest:
    """One schema per part: millions of structs that hold structs; of some the bytes fit no value."""
    rows = _part_schema(table(spark, sf_dir, "part"), "concat('vast-', p_partkey div 128)", f"concat('int16 h; Mid m[', {VAST}, ']; int8 t')")
    nested = [_schema_rows(rows, "Mid", "int8 q; In i[5]", 1), _schema_rows(rows, "In", "int32 a; double b[3]", 2)]
    return keyed_ingest(rows.unionByName(nested[0]).unionByName(nested[1]))


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part/<l_partkey>`` at the ship date = quantity: much rewritten keys, in file order."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("lines").alias("recording"),
        F.expr("concat('part/', l_partkey)").alias("key"),
        F.expr("unix_micros(cast(l_shipdate as timestamp))").alias("ts"),
        F.expr("l_orderkey * 8 + l_linenumber").alias("eff"),
        F.expr(f"l_suppkey * 1000000000 + {LINE_CENTS}").alias("seq"),
        F.lit(CODE["double"]).alias("code"),
        E.le_double(F.col("l_quantity")).alias("bytes"),
        F.lit(None).cast("bigint").alias("n"),
    )
