"""Entity-path and type-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def normalise_name(name: Column) -> Column:
    """Drop one ``NT:`` prefix, then every leading slash."""
    return F.regexp_replace(name, "^(NT:)?/*", "")


def clean_path(name: Column) -> Column:
    """Slash-separated path without empty, ``.`` and resolvable ``..`` parts."""
    parts = F.filter(F.split(name, "/"), lambda p: (p != "") & (p != "."))
    empty = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        top = F.try_element_at(done, F.lit(-1))
        pops = (part == "..") & top.isNotNull() & (top != "..")
        return F.when(pops, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(
            F.array_append(done, part)
        )

    dotted = name.rlike(r"(^|/)\.\.?(/|$)")
    return F.array_join(F.when(dotted, F.aggregate(parts, empty, step)).otherwise(parts), "/")


def join_path(parent: Column, child: Column) -> Column:
    return F.when(parent == "", child).otherwise(F.concat_ws("/", parent, child))


def parent_path(key: Column) -> Column:
    """All but the last part; the root ``''`` is the parent of one-part keys and of itself."""
    return F.regexp_extract(key, "^(.*)/[^/]*$", 1)


def last_part(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def ancestors(key: Column) -> Column:
    """Every proper ancestor of a key, from the root down."""
    parts = F.split(key, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(parts, F.lit(1), n), "/")),
    )


def parent_key(key: Column) -> Column:
    """The last of the ancestors of a key that isn't empty."""
    return F.substring(key, F.lit(1), F.length(key) - F.length(F.substring_index(key, "/", -1)) - 1)


def is_array_type(entry_type: Column) -> Column:
    return F.endswith(entry_type, F.lit("[]"))


def base_type(entry_type: Column) -> Column:
    """The type name without one trailing ``[]``."""
    return F.regexp_replace(entry_type, r"\[\]$", "")


def robotime_nanos(ts: Column) -> Column:
    """Microseconds to the nanosecond timeline; NULL where it does not fit 64 bits."""
    return F.try_multiply(ts, F.lit(1000).cast("bigint"))


def robotime_interval(ts: Column) -> Column:
    return F.make_dt_interval(secs=(ts / F.lit(MICROS)).cast("decimal(18,6)"))
