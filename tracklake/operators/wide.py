"""One struct column per record of a struct type, cut straight out of its bytes.

Records with equal layouts are cut together: a batch's bytes are one matrix, a field is a slice of it. Layouts are
addressed by content, so recordings that repeat a schema share one. Where the distinct layouts are too large to send
to the tasks, or a field mixes text with numbers over its versions, column expressions cut record by record.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.binary import bits_of_hex, le_hex, real, signed, uint64_of_hex, utf8_lossy
from tracklake.functions.paths import join_path
from tracklake.operators.collisions import repeated
from tracklake.operators.entries import ENTRY_KEY
from tracklake.operators.lookup import HOT_ROWS, fits_broadcast, lookup_join
from tracklake.operators.schemas import element_place, elements
from tracklake.operators.structs import struct_issue
from tracklake.session import stage

REALS, TEXTS = ("float", "double"), ("char", "bool")
#: Text of the distinct layouts of one struct that is sent to every task.
SHAPE_BYTES = 8 << 20
#: Bytes of bodies that are cut at once; a longer body is cut alone.
SLICE_BYTES = 16 << 20
_ARROW = {"boolean": pa.bool_(), "string": pa.binary(), "bigint": pa.int64(), "decimal(20,0)": pa.decimal128(20, 0), "double": pa.float64(), "float": pa.float32()}
_SPARK = {"boolean": T.BooleanType(), "string": T.BinaryType(), "bigint": T.LongType(), "decimal(20,0)": T.DecimalType(20, 0), "double": T.DoubleType(), "float": T.FloatType()}


def wide_type(prims: set[str]) -> str:
    """The one type that holds a field's values over all versions of its schema."""
    kinds = {"boolean" if p == "bool" else "string" if p == "char" else p if p in REALS else "decimal(20,0)" if p == "uint64" else "bigint" for p in prims}
    if len(kinds) == 1:
        return kinds.pop()
    if kinds & {"boolean", "string"}:
        return "string"
    return "double" if kinds & set(REALS) else "decimal(20,0)"


def _name(leaf: Column) -> Column:
    return F.array_join(leaf["pieces"], "/")


def wide_fields(layouts: DataFrame, struct_name: str) -> list[tuple[str, str, bool, bool, tuple[str, ...]]]:
    """(name, type, is array, lies in an array of structs, primitives) of a struct's leaves over all recordings and versions: one row per leaf of the schema text."""
    leaf = layouts.filter("complete and problem is null").filter(F.col("struct_name") == struct_name).select(F.explode("leaves").alias("leaf"))
    many = ((F.col("leaf.prim") != "char") & F.col("leaf.count").isNotNull()) | (F.size("leaf.dims") > 0)
    rows = leaf.filter("leaf.prim <> 'length'").groupBy(_name(F.col("leaf")).alias("name")).agg(F.collect_set("leaf.prim").alias("prims"), F.max(many).alias("many"), F.max(F.size("leaf.dims") > 0).alias("deep"))
    return sorted((r["name"], wide_type(set(r["prims"])), r["many"], r["deep"], tuple(sorted(r["prims"]))) for r in rows.collect())


def _value(raw: Column, prim: Column, prims: tuple[str, ...], to: str) -> Column:
    bits = bits_of_hex(le_hex(raw))
    by_kind = {
        "bool": raw != F.lit(b"\x00"), "char": F.rtrim(utf8_lossy(raw), F.lit("\0")), "uint64": uint64_of_hex(le_hex(raw)),
        "float": real(bits, F.lit(False)), "double": real(bits, F.lit(True)),
    }
    out = None
    for p in prims:
        value = by_kind.get(p, signed(bits, F.octet_length(raw)) if p.startswith("int") else bits).cast(to)
        out = F.when(prim == p, value) if out is None else out.when(prim == p, value)
    return out


def _field(name: str, to: str, many: bool, deep: bool, prims: tuple[str, ...]) -> Column:
    leaf = F.try_element_at("_leaves", F.lit(name))
    text = leaf["prim"] == "char"
    count = F.coalesce(leaf["count"], F.lit(1)).cast("bigint")
    width = F.when(text, leaf["width"] * count).otherwise(leaf["width"])

    def cut(at: Column) -> Column:
        return F.substring(F.col("body"), (leaf["offset"] + at).cast("int") + 1, width.cast("int"))

    if not many:
        return _value(cut(F.lit(0)), leaf["prim"], prims, to)
    own = F.when(text, F.lit(1).cast("bigint")).otherwise(count)
    if deep:
        n = own * elements(leaf["dims"])
        place = lambda j: element_place(leaf["pieces"], leaf["dims"], F.call_function("div", j, own))["at"] + j % own * leaf["width"]
    else:
        n, place = own, lambda j: j * leaf["width"]
    each = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda j: _value(cut(place(j)), leaf["prim"], prims, to))
    return F.when(leaf.isNotNull(), each)


def _name_of(leaf: dict) -> str:
    return "/".join(leaf["pieces"])


def shape_fields(shapes: list[list[dict]]) -> list[tuple[str, str, bool, bool, tuple[str, ...]]]:
    """``wide_fields`` of layouts that are at hand."""
    found: dict[str, list] = {}
    for leaf in (leaf for shape in shapes for leaf in shape):
        field = found.setdefault(_name_of(leaf), [set(), False, False])
        field[0].add(leaf["prim"])
        field[2] |= bool(leaf["dims"])
        field[1] |= field[2] or (leaf["prim"] != "char" and leaf.get("count") is not None)
    return sorted((name, wide_type(prims), many, deep, tuple(sorted(prims))) for name, (prims, many, deep) in found.items())


def _cut(body: np.ndarray, leaf: dict, to: str, many: bool) -> pa.Array:
    """A field of the bodies, a row each of ``body``, as values of ``to`` or lists of them."""
    count, text = leaf.get("count") or 1, leaf["prim"] == "char"
    width, own = (leaf["width"] * count, 1) if text else (leaf["width"], count)
    at = np.zeros(1, np.int64)
    for dim in leaf["dims"]:
        at = (at[:, None] + np.arange(dim["n"]) * dim["stride"]).ravel()
    first, run = leaf["offset"] + at, own * width
    raw = body[:, first[0] : first[0] + run] if len(at) == 1 else body[:, (first[:, None] + np.arange(run)).ravel()]
    raw = np.ascontiguousarray(raw).reshape(-1)
    each = len(at) * own
    if text:
        values = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(body) * each, [None, pa.py_buffer(raw)]).cast(pa.binary())
    elif leaf["prim"] == "bool":
        values = pa.array(raw.reshape(-1, width).any(axis=1))
    else:
        kind = "f" if leaf["prim"] in REALS else "u" if leaf["prim"].startswith("u") else "i"
        numbers = raw.view(f"<{kind}{width}")
        values = pa.array(numbers.astype(np.float64) if to == "double" else numbers).cast(_ARROW[to])
    if not many:
        return values
    return pa.ListArray.from_arrays(pa.array(np.arange(len(body) + 1) * each, pa.int32()), values)


def _cutter(fields: list, shapes: dict[str, dict[str, dict]]):
    kinds = [pa.list_(_ARROW[to]) if many else _ARROW[to] for _, to, many, _, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("shape").dictionary_encode()
            codes = of.indices.to_numpy()
            for code, shape in enumerate(of.dictionary.to_pylist()):
                same = batch.take(pa.array(np.flatnonzero(codes == code)))
                lengths = pc.binary_length(same.column("body"))
                step = max(1, SLICE_BYTES // max(1, lengths[0].as_py()))
                for lo in range(0, len(same), step):
                    rows = same.slice(lo, step)
                    body = np.frombuffer(b"".join(x.as_buffer() for x in rows.column("body")), np.uint8).reshape(len(rows), -1)
                    leaves = shapes[shape]
                    cut = [_cut(body, leaves[f[0]], f[1], f[2]) if f[0] in leaves else pa.nulls(len(rows), kind) for f, kind in zip(fields, kinds, strict=True)]
                    value = pa.StructArray.from_arrays(cut, names=[f[0] for f in fields])
                    yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("recording", "key", "ts")), value], names=["recording", "key", "ts", "value"])

    return run


def _by_shape(last: DataFrame, known: DataFrame, shapes: dict[str, list[dict]], min_rows: int) -> DataFrame:
    fields = shape_fields(list(shapes.values()))
    placed = lookup_join(last, known.select("recording", "epoch", "shape"), ["recording", "epoch"], "inner", min_rows=min_rows)
    value = T.StructType([T.StructField(name, T.ArrayType(_SPARK[to]) if many else _SPARK[to]) for name, to, many, _, _ in fields])
    kept = [placed.schema[c] for c in ("recording", "key", "ts")]
    named = {shape: {_name_of(leaf): leaf for leaf in leaves} for shape, leaves in shapes.items()}
    rows = placed.select("recording", "key", "ts", "shape", "body").mapInArrow(_cutter(fields, named), T.StructType([*kept, T.StructField("value", value)]))
    text = lambda c: F.rtrim(utf8_lossy(c), F.lit("\0"))
    parts = []
    for name, to, many, _, _ in fields:
        raw = F.col("value")[name]
        parts.append((raw if to != "string" else F.transform(raw, text) if many else text(raw)).alias(name))
    return rows.select("recording", "key", "ts", F.struct(*parts).alias("value"))


def known_shapes(layouts: DataFrame, struct_name: str) -> DataFrame:
    """(recording, epoch, shape, text): the leaves of each usable version of a struct as text, and a hash of it."""
    usable = layouts.filter(F.col("struct_name") == struct_name).filter("complete and problem is null")
    text = F.to_json(F.filter("leaves", lambda x: x["prim"] != "length"))
    return usable.select("recording", F.col("schema_seq").alias("epoch"), text.alias("text")).withColumn("shape", F.sha2("text", 256))


def _last_writes(rows: DataFrame, min_rows: int) -> DataFrame:
    """(recording, key, ts, epoch, body) of the last write of each key and time; only what is written more than once is shuffled."""
    twice, some = repeated(rows, ENTRY_KEY[:2], ENTRY_KEY[2], min_rows=min_rows)
    plain = rows.select(*ENTRY_KEY, "_last.*")
    if not some:
        return plain
    marked = lookup_join(rows, twice.withColumn("_twice", F.lit(True)), ENTRY_KEY, "left", min_rows=min_rows)
    met = marked.filter("_twice").groupBy(*ENTRY_KEY).agg(F.max_by("_last", "_order").alias("_last"))
    return marked.filter("_twice is null").select(*ENTRY_KEY, "_last.*").unionByName(met.select(*ENTRY_KEY, "_last.*"))


def wide_structs(with_layout: DataFrame, layouts: DataFrame, struct_name: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """(recording, key, ts, value) of every record, and every array element, of ``struct_name``; the last write of a key and time wins.

    A field that a version of the schema lacks is NULL in its records. Fields keep their path in the schema as name; primitive
    arrays are arrays, and so are the fields of arrays of structs, over all elements in byte order.
    """
    size, i = F.col("layout.struct_size"), F.col("_i")
    rows = with_layout.filter(F.col("struct_name") == struct_name).filter("layout.epoch is not null").filter(struct_issue().isNull())
    many = F.sequence(F.lit(0), (F.octet_length("data") / size).cast("int") - 1)
    index = F.when(~F.col("is_array"), F.array(F.lit(-1))).when(F.octet_length("data") > 0, many)
    part = F.substring("data", i * size.cast("int") + 1, size.cast("int"))
    rows = rows.withColumn("_i", F.explode(index)).select(
        "recording", F.when(i < 0, F.col("key")).otherwise(join_path(F.col("key"), i.cast("string"))).alias("key"), "ts",
        F.struct(F.greatest("seq", "layout.epoch"), "seq").alias("_order"),
        F.struct(F.col("layout.epoch").alias("epoch"), F.when(i < 0, F.substring("data", 1, size.cast("int"))).otherwise(part).alias("body")).alias("_last"),
    )
    last = _last_writes(rows, min_rows)
    known = stage(known_shapes(layouts, struct_name), "shapes")
    distinct = known.select("shape", "text").distinct()
    if fits_broadcast(distinct, SHAPE_BYTES):
        shapes = {r["shape"]: json.loads(r["text"]) for r in distinct.collect()}
        mixed = any(to == "string" and prims != ("char",) for _, to, _, _, prims in shape_fields(list(shapes.values())))
        if shapes and any(shapes.values()) and not mixed:
            return _by_shape(last, known, shapes, min_rows)
    return _by_record(last, layouts, struct_name, min_rows)


def _by_record(last: DataFrame, layouts: DataFrame, struct_name: str, min_rows: int) -> DataFrame:
    leaves = F.map_from_entries(F.transform(F.filter("leaves", lambda x: x["prim"] != "length"), lambda x: F.struct(_name(x), x)))
    known = layouts.filter(F.col("struct_name") == struct_name).select("recording", F.col("schema_seq").alias("epoch"), leaves.alias("_leaves"))
    placed = lookup_join(last, known, ["recording", "epoch"], "inner", min_rows=min_rows)
    parts = [_field(*field).alias(field[0]) for field in wide_fields(layouts, struct_name)]
    return placed.select("recording", "key", "ts", F.struct(*parts).alias("value"))
