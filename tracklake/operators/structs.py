"""Values to cells: one row per scalar, with its key and its raw bytes.

Arrays get a ``length`` cell (index -1 below) and one cell per element; structs get the
cells of their layout. Nothing is decoded here, so that later shuffles carry bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.binary import CODE, literal_map
from tracklake.functions.paths import join_path
from tracklake.operators.lookup import HOT_ROWS, lookup_join
from tracklake.operators.ordered import fill_forward, version_lookup
from tracklake.operators.quality import SCALAR_TYPES, element_bytes, is_schema, is_struct, quarantine, value_issue
from tracklake.operators.schemas import SCHEMA, with_elements

PLAIN_CODES = {kind: CODE[kind] for kind in SCALAR_TYPES}


def _indexed(key: Column, i: Column) -> Column:
    return F.when(i.isNull(), key).otherwise(
        join_path(key, F.when(i < 0, "length").otherwise(i.cast("string")))
    )


def _indexes(is_array: Column, n: Column) -> Column:
    """[-1, 0, .. n-1] for arrays (so never an empty sequence), one NULL for scalars."""
    return F.explode(
        F.when(is_array, F.sequence(F.lit(-1), n.cast("int") - 1)).otherwise(F.array(F.lit(None).cast("int")))
    )


def _extra(df: DataFrame) -> list[str]:
    return ["contested"] if "contested" in df.columns else []


def plain_cells(keyed: DataFrame) -> DataFrame:
    """Cells of the scalar and primitive-array entries that pass the length checks."""
    width = element_bytes()
    n = (F.octet_length("data") / width).cast("int")
    i, w = F.col("_i"), F.col("_w").cast("int")
    return (
        keyed.filter(~is_struct() & ~is_schema() & value_issue().isNull())
        .withColumn("_w", width)
        .withColumn("_n", n)
        .withColumn("_i", _indexes(F.col("is_array"), F.col("_n")))
        .select(
            "recording",
            _indexed(F.col("key"), i).alias("key"),
            "ts",
            F.col("seq").alias("eff"),
            "seq",
            F.when(i < 0, CODE["length"]).otherwise(F.try_element_at(literal_map(PLAIN_CODES), F.col("base_type"))).alias("code"),
            F.when(i >= 0, F.substring(F.col("data"), i * w + F.lit(1), w))
            .when(i.isNull(), F.when(w.isNull(), F.col("data")).otherwise(F.substring(F.col("data"), F.lit(1), w)))
            .alias("bytes"),
            F.when(i < 0, F.col("_n")).cast("bigint").alias("n"),
            *_extra(keyed),
        )
    )


def decode_versions(layouts: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Per struct, which layout a record at or after ``since`` uses.

    A record uses the registry as of its own position. Where the struct is not complete
    there, it waits for the next registration that completes it (``epoch`` > its ``seq``);
    ``epoch`` is NULL where that never happens.
    """
    detail = F.struct(F.col("schema_seq").alias("epoch"), "problem", "struct_size")
    rows = layouts.select(*SCHEMA, "schema_seq", F.when(F.col("complete"), detail).alias("_layout"))
    before = layouts.select(*SCHEMA).distinct().withColumn("schema_seq", F.lit(-1).cast("bigint"))
    both = rows.unionByName(before, allowMissingColumns=True).withColumn("_down", -F.col("schema_seq"))
    filled = fill_forward(both, SCHEMA, ["_down"], {"_use": F.col("_layout")}, min_rows=min_rows)
    # what a record waits for in the end is what the newest registration still lacks
    lacking = layouts.groupBy(*SCHEMA).agg(F.max_by("missing", "schema_seq").alias("missing"))
    return filled.join(lacking, SCHEMA).select(
        *SCHEMA, F.col("schema_seq").alias("since"), "missing", "_use.epoch", "_use.problem", "_use.struct_size",
    )


def attach_layout(keyed: DataFrame, decode_versions: DataFrame, **limits) -> DataFrame:
    """Struct records with ``layout``; its ``epoch`` is NULL for records still waiting."""
    rows = keyed.filter(is_struct()).withColumn("struct_name", F.col("base_type"))
    return version_lookup(rows, decode_versions, SCHEMA, "seq", "since", "layout", **limits)


def without_layout(keyed: DataFrame) -> DataFrame:
    """The same for recordings without any schema: every struct record waits."""
    nothing = "struct<since:bigint,missing:string,epoch:bigint,problem:string,struct_size:bigint>"
    rows = keyed.filter(is_struct()).withColumn("struct_name", F.col("base_type"))
    return rows.withColumn("layout", F.lit(None).cast(nothing))


def unresolved(with_layout: DataFrame) -> DataFrame:
    """Records whose struct (or a nested one) never arrives."""
    return with_layout.filter("layout.epoch is null").select(
        "recording",
        F.coalesce("layout.missing", "struct_name").alias("missing_struct"),
        "seq",
        "ts",
        "key",
        "entry_type",
        "data",
    )


def struct_issue() -> Column:
    size, whole = F.octet_length("data"), F.col("layout.struct_size")
    return (
        F.when(F.col("layout.problem").isNotNull(), F.col("layout.problem"))
        .when(F.col("is_array") & (whole == 0), "zero-size struct array")
        .when(F.col("is_array") & (F.pmod(size, F.nullif(whole, F.lit(0).cast("bigint"))) != 0), "trailing partial element")
        .when(~F.col("is_array") & (size < whole), "too few bytes for a struct")
    )


def struct_problems(with_layout: DataFrame) -> DataFrame:
    rows = with_layout.filter("layout.epoch is not null").withColumn("reason", struct_issue())
    return quarantine(rows.filter("reason is not null"), "struct")


def struct_cells(with_layout: DataFrame, leaves: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Cells of struct and struct-array records: one row per element joined to its leaves."""
    size = F.col("layout.struct_size")
    i, at = F.col("_i"), F.col("_i").cast("bigint") * size
    n = (F.octet_length("data") / F.nullif(size, F.lit(0).cast("bigint"))).cast("int")
    base = F.when(i >= 0, join_path(F.col("key"), i.cast("string"))).otherwise(F.col("key"))
    whole = F.when(i >= 0, F.substring(F.col("data"), at.cast("int") + F.lit(1), size.cast("int")))
    elements = (
        with_layout.filter("layout.epoch is not null")
        .filter(struct_issue().isNull())
        .withColumn("_n", n)
        .withColumn("_i", _indexes(F.col("is_array"), F.col("_n")))
        .withColumn("_base", base)
        .select(
            "recording",
            "struct_name",
            "layout.epoch",
            F.coalesce(i < 0, F.lit(False)).alias("is_length"),
            F.when(F.col("_base") == "", "").otherwise(F.concat("_base", F.lit("/"))).alias("_prefix"),
            "ts",
            F.greatest("seq", "layout.epoch").alias("eff"),
            "seq",
            F.when(i.isNull(), F.col("data")).otherwise(whole).alias("_body"),
            F.when(i < 0, F.col("_n")).cast("bigint").alias("_count"),
            *_extra(with_layout),
        )
    )
    by = ["recording", "struct_name", "epoch", "is_length"]
    at_once, later = leaves.filter("size(dims) = 0"), leaves.filter("size(dims) > 0")
    plain = at_once.withColumn("path", F.element_at("pieces", 1)).withColumn("at", F.lit(0).cast("bigint")).drop("pieces", "dims")
    cells = lookup_join(elements, plain, by, "inner", min_rows=min_rows)
    if not later.isEmpty():  # elements of long arrays are made here, where a record that holds them is
        large = with_elements(lookup_join(elements, later, by, "inner", min_rows=min_rows))
        cells = cells.unionByName(large.drop("pieces", "dims"))
    return cells.select(
        "recording",
        F.concat("_prefix", "path").alias("key"),
        "ts",
        "eff",
        "seq",
        "code",
        F.when(F.col("width") > 0, F.substring(F.col("_body"), (F.col("offset") + F.col("at")).cast("int") + F.lit(1), F.col("width"))).alias("bytes"),
        F.coalesce("n", "_count").alias("n"),
        *_extra(with_layout),
    )
