"""Entities and their components: detection, component list, as-of lookup, row assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.paths import ancestors, last_part, parent_path, robotime_nanos
from tracklake.operators.entries import VALUES, latest_per_key
from tracklake.operators.lookup import HOT_ROWS, lookup_join
from tracklake.operators.ordered import fill_forward
from tracklake.operators.quality import quarantine
from tracklake.session import stage

ENTITY = ["recording", "entity"]
# Fixed values the entity convention uses.
TYPE_KEY, COMPONENTS_KEY, ENTITY_TYPE = ".type", ".components", "Entity"
SCALAR, POINT3D = "Scalar", "Point3d"
AXES = ("x", "y", "z")


def _markers(entries: DataFrame) -> DataFrame:
    """Latest ``.type`` / ``.components`` / ``.components/<i>`` texts with their entity."""
    key = F.col("key")
    leaf, above = last_part(key), parent_path(key)
    listed = (last_part(above) == COMPONENTS_KEY) & leaf.rlike("^[0-9]+$")
    marks = entries.filter(leaf.isin(TYPE_KEY, COMPONENTS_KEY) | listed)
    return latest_per_key(marks).select(
        "recording",
        F.when(listed, parent_path(above)).otherwise(above).alias("entity"),
        F.when(listed, COMPONENTS_KEY).otherwise(leaf).alias("mark"),
        F.when(listed, leaf.cast("int")).alias("place"),
        F.when(F.col("vtype") == "string", F.col("v_string")).alias("text"),
    )


def entity_components(entries: DataFrame) -> DataFrame:
    """(recording, entity, components): entities are typed ``Entity`` and name components.

    The latest ``.type`` and ``.components`` of the whole recording decide, not those of
    the moment. A component list has the size of what was written under one key.
    """
    marks = _markers(entries)
    named = (F.col("mark") == COMPONENTS_KEY) & F.col("text").isNotNull()
    per_entity = marks.groupBy(*ENTITY).agg(
        F.bool_or((F.col("mark") == TYPE_KEY) & (F.col("text") == ENTITY_TYPE)).alias("typed"),
        F.array_distinct(
            F.transform(
                F.sort_array(F.collect_list(F.when(named, F.struct("place", "text")))), lambda p: p["text"]
            )
        ).alias("components"),
    )
    return per_entity.filter(F.col("typed") & (F.size("components") > 0)).drop("typed")


def entities_found(entries: DataFrame) -> DataFrame:
    return entity_components(entries).select(*ENTITY)


def component_list(entries: DataFrame) -> DataFrame:
    return entity_components(entries).select(*ENTITY, F.explode("components").alias("component"))


def _roles(trigger: str) -> Column:
    """What an entry is to the entities above it: a change, a Scalar, a Point3d axis."""
    key = F.col("key")
    leaf, above = last_part(key), parent_path(key)
    role = lambda entity, name: F.struct(entity.alias("entity"), name.alias("role"))
    if trigger == "direct":
        changes = F.array(role(above, F.lit("change")))
    elif trigger == "subtree":
        changes = F.transform(ancestors(key), lambda a: role(a, F.lit("change")))
    else:
        raise ValueError("trigger is 'direct' or 'subtree'")
    scalar = F.when(leaf == SCALAR, role(above, F.lit("scalar")))
    axis = F.when(leaf.isin(*AXES) & (last_part(above) == POINT3D), role(parent_path(above), leaf))
    return F.filter(F.concat(changes, F.array(scalar, axis)), lambda r: r.isNotNull())


NUMBER, EMPTY, NO_NUMBER = 1, 2, 3


def as_double() -> Column:
    """The value as a 64-bit float, where it has such a form."""
    return F.coalesce(
        F.col("v_double"),
        F.col("v_float").cast("double"),
        F.col("v_long").cast("double"),
        F.col("v_dec").cast("double"),
        F.col("v_bool").cast("double"),
        F.col("v_string").try_cast("double"),
    )


def _state() -> Column:
    """Whether the value is a number, a stored NULL, or neither (bytes, unreadable text)."""
    return (
        F.when(as_double().isNotNull(), NUMBER)
        .when(F.col("v_string").isNotNull() | (F.col("vtype") == "raw"), NO_NUMBER)
        .otherwise(EMPTY)
    )


def component_rows(entries: DataFrame, trigger: str = "direct", min_rows: int = HOT_ROWS) -> DataFrame:
    """One row per (entity, change time, component), with its value or its ``reason``.

    Changes and component values of an entity are first put together per timestamp (hash
    aggregation on fixed-width columns), then one window pass carries the four component
    values forward.
    """
    found = stage(entity_components(entries), "entities")
    roles = (
        entries.withColumn("value", as_double())
        .withColumn("state", _state())
        .select("recording", "ts", "value", "state", F.explode(_roles(trigger)).alias("r"))
        .select("recording", "r.entity", "r.role", "ts", "value", "state")
    )
    mine = lookup_join(roles, found.select(*ENTITY), ENTITY, "left_semi", min_rows=min_rows)
    names = {"scalar": "scalar", **{f"axis_{a}": a for a in AXES}}
    at = [F.max(F.when(F.col("role") == r, F.col(c))).alias(f"_{c}_{n}") for n, r in names.items() for c in ("value", "state")]
    merged = mine.groupBy(*ENTITY, "ts").agg(F.count_if(F.col("role") == "change").alias("n_triggers"), *at)
    known = {
        n: F.when(
            F.col(f"_state_{n}").isNotNull(),
            F.struct(F.col(f"_value_{n}").alias("value"), (F.col(f"_state_{n}") != NO_NUMBER).alias("ok")),
        )
        for n in names
    }
    filled = fill_forward(merged, ENTITY, ["ts"], known, min_rows=min_rows)
    changed = filled.filter("n_triggers > 0").select(*ENTITY, "ts", "n_triggers", *names)
    rows = lookup_join(changed, found, ENTITY, "inner", min_rows=min_rows).withColumn(
        "component", F.explode("components")
    )
    is_scalar, is_point = F.col("component") == SCALAR, F.col("component") == POINT3D
    axes = [F.col(f"axis_{a}") for a in AXES]
    lost = F.coalesce(*[F.when(c.isNull(), F.lit(f"no value for {a}")) for a, c in zip(AXES, axes)])
    bad_axis = ~(axes[0]["ok"] & axes[1]["ok"] & axes[2]["ok"])
    reason = (
        F.when(robotime_nanos(F.col("ts")).isNull(), "timestamp out of range")
        .when(is_scalar, F.when(F.col("scalar").isNull(), "no value").when(~F.col("scalar.ok"), "cannot cast to double"))
        .when(is_point, F.coalesce(lost, F.when(bad_axis, "cannot cast to double")))
        .otherwise("unknown component")
    )
    point = F.array(*[c["value"].cast("float") for c in axes])
    return rows.withColumn("reason", reason).select(
        *ENTITY,
        "ts",
        "component",
        F.when(is_scalar & F.col("reason").isNull(), F.col("scalar.value")).alias("scalar"),
        F.when(is_point & F.col("reason").isNull(), point).alias("point3d"),
        "n_triggers",
        "reason",
    )


def entity_rows(component_rows: DataFrame) -> DataFrame:
    return component_rows.filter("reason is null").drop("reason")


def component_problems(component_rows: DataFrame) -> DataFrame:
    key = F.concat_ws("/", F.nullif(F.col("entity"), F.lit("")), F.col("component"))
    return quarantine(component_rows.filter("reason is not null").withColumn("key", key), "component")


CHUNK_MICROS = 3_600_000_000


def entity_chunks(entity_rows: DataFrame, span: int | None = CHUNK_MICROS) -> DataFrame:
    """Rows grouped per entity and ``span`` microseconds of its recording's time, whatever their number.

    ``chunk`` is the place of the span. A recording shorter than the span, which an hour
    usually is, gives one chunk per entity; ``None`` gives one in any case, for entities of bounded length.
    """
    chunk = F.lit(0).cast("bigint") if span is None else F.floor(F.col("ts") / span).cast("bigint")
    placed = entity_rows.withColumn("chunk", chunk)
    row = F.struct("ts", "component", "scalar", "point3d", "n_triggers")
    return placed.groupBy(*ENTITY, "chunk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list(row)).alias("rows")
    )
