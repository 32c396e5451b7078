"""The entry log: last write wins, typed decode, latest values, series, changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.binary import CELL_KINDS, CODE, STORED_NAMES, bits_of_hex, le_hex, signed, uint64_of_hex, utf8_lossy, with_real
from tracklake.functions.paths import ancestors, parent_key
from tracklake.operators.collisions import repeated
from tracklake.operators.lookup import HOT_ROWS, lookup_join
from tracklake.operators.ordered import asof_join
from tracklake.operators.quality import is_schema
from tracklake.session import stage, stage_counted

VALUES = ["vtype", "v_bool", "v_long", "v_dec", "v_float", "v_double", "v_string", "v_binary"]
ENTRY_KEY = ["recording", "key", "ts"]

def overlapping(names: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """(recording, key) of entries that may write a key of another entry.

    ``names`` is (recording, key, compound), repeated or not: an array or struct entry writes below its own
    key, so it can meet an entry named there.
    Few names stand above another one; they are gathered first, within each task and by parents, so that usually none of the
    others is shuffled or split.
    """
    below = names.select("recording", F.col("key").alias("lower"), F.explode(ancestors(F.col("key"))).alias("key")).filter("lower <> key")
    parents = names.filter("key <> ''").select("recording", parent_key(F.col("key")).alias("key")).distinct()
    farther = parents.select("recording", F.explode(F.array_append(ancestors(F.col("key")), F.col("key"))).alias("key"))
    above = stage(farther.distinct(), "names-above")
    compound = names.filter("compound").select("recording", "key")
    upper, n_upper = stage_counted(lookup_join(compound, above, ["recording", "key"], "left_semi", min_rows=min_rows).distinct(), "compound-above")
    if not n_upper:
        return upper
    pairs = lookup_join(below, upper, ["recording", "key"], min_rows=min_rows)
    return pairs.select("recording", F.explode(F.array("key", "lower")).alias("key")).distinct()


def mark_contested(keyed: DataFrame, names: DataFrame, min_rows: int = HOT_ROWS) -> tuple[DataFrame, bool]:
    """Add ``contested``: whether another record may write the same (key, ts).

    Suspects are found where records are read; only they are counted. Usually few or no
    records are contested, and no other one is shuffled, neither its key nor its payload.
    """
    shared, n_shared = stage_counted(overlapping(names, min_rows), "shared-keys")
    twice, n_twice = repeated(keyed.filter(~is_schema()), ENTRY_KEY[:2], ENTRY_KEY[2], min_rows=min_rows)
    marks = []
    if n_shared:
        keyed = lookup_join(keyed, shared.withColumn("_shared", F.lit(True)), ["recording", "key"], "left", min_rows=min_rows)
        marks.append("_shared")
    if n_twice:
        keyed = lookup_join(keyed, twice.withColumn("_twice", F.lit(True)), ENTRY_KEY, "left", min_rows=min_rows)
        marks.append("_twice")
    marked = F.coalesce(*[F.col(m) for m in marks], F.lit(False))
    return keyed.withColumn("contested", marked).drop(*marks), bool(marks)


def last_write_wins(cells: DataFrame) -> DataFrame:
    """One cell per (recording, key, ts): the one written last, by (eff, seq).

    Runs on raw bytes; the partial aggregation keeps one row per key and task, so a
    much-rewritten key does not pile up in one task.
    """
    return (
        cells.groupBy(*ENTRY_KEY)
        .agg(F.max_by(F.struct("eff", "seq", "code", "bytes", "n"), F.struct("eff", "seq")).alias("w"))
        .select(*ENTRY_KEY, "w.*")
    )


def decode_cells(cells: DataFrame) -> DataFrame:
    """Replace ``(eff, seq, code, bytes, n)`` by ``ord`` and the typed value columns."""
    code, raw, bits, number = F.col("code"), F.col("bytes"), F.col("_bits"), F.col("_real")
    between = lambda low, high: code.between(CODE[low], CODE[high])
    text = utf8_lossy(raw)
    names = [STORED_NAMES.get(k, k) for k in CELL_KINDS]
    # digits, bits and reals in projections of their own: computed once per cell, and the
    # whole generated method stays below the size that the JIT compiler accepts (8,000 bytes)
    numbers = cells.withColumn("_hex", F.when(code >= CODE["int8"], le_hex(raw)))
    numbers = numbers.withColumn("_bits", F.when(code != CODE["uint64"], bits_of_hex(F.col("_hex"))))
    numbers = with_real(numbers, "_real", bits, code == CODE["double"])
    return numbers.select(
        *ENTRY_KEY,
        F.struct("eff", "seq").alias("ord"),
        F.get(F.lit(names), code).alias("vtype"),
        F.when((code == CODE["boolean"]) & (F.octet_length(raw) > 0), raw != F.lit(b"\x00")).alias("v_bool"),
        F.when(code == CODE["length"], F.col("n"))
        .when(between("int8", "int64"), signed(bits, F.octet_length(raw)))
        .when(between("uint8", "uint32"), bits)
        .alias("v_long"),
        F.when(code == CODE["uint64"], uint64_of_hex(F.col("_hex"))).alias("v_dec"),
        F.when(code == CODE["float"], number.cast("float")).alias("v_float"),
        F.when(code == CODE["double"], number).alias("v_double"),
        F.when(code.isin(CODE["string"], CODE["char"]), text)
        .when(code == CODE["char[]"], F.rtrim(text, F.lit("\0")))
        .alias("v_string"),
        F.when(code == CODE["raw"], raw).alias("v_binary"),
    )


def entries(cells: DataFrame, some_contested: bool = True) -> DataFrame:
    """The entry log from cells; ``contested`` cells, or all where the mark is absent,
    go through last-write-wins, the others are decoded in place."""
    if "contested" not in cells.columns:
        return decode_cells(last_write_wins(cells))
    plain = decode_cells(cells.filter("not contested"))
    if not some_contested:
        return plain
    return plain.unionByName(decode_cells(last_write_wins(cells.filter("contested"))))


def value_struct() -> Column:
    """The value as one struct; never NULL, so that a stored NULL counts as a value."""
    return F.struct(*VALUES)


def latest_per_key(entries: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Value at the greatest timestamp of each key.

    The greatest timestamps come from a hash aggregation without payload; they then pick
    their rows, (recording, key, ts) being unique.
    """
    newest = stage(entries.groupBy("recording", "key").agg(F.max("ts").alias("ts")), "newest")
    return lookup_join(entries, newest, ENTRY_KEY, "left_semi", min_rows=min_rows).select(*ENTRY_KEY, *VALUES)


def key_series(entries: DataFrame, key: str, recording: str | None = None) -> DataFrame:
    """All values of one key in time order; key and recording filters reach the Parquet scan."""
    rows = entries.filter(F.col("key") == key)
    if recording is not None:
        rows = rows.filter(F.col("recording") == recording)
    return rows.orderBy("recording", "ts")


def change_set(entries: DataFrame) -> DataFrame:
    """Every (key, ts) written, with its current value. In streaming: those of one micro-batch."""
    return entries.select(*ENTRY_KEY, *VALUES)


def asof_values(probes: DataFrame, entries: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """For each (recording, key, ts) probe the newest value at or before it, as ``match``."""
    return asof_join(
        probes, entries.select(*ENTRY_KEY, *VALUES), ["recording", "key"], "ts", min_rows=min_rows
    )
