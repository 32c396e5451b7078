"""Little-endian decoding of BINARY columns.

All of it is built-in expressions: nothing leaves the JVM between the Parquet scan and
the result. Bits are taken once with ``conv(hex(...))``; a real number is its mantissa
times a power of two from a constant array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a cell can hold, by code (the position in this list), and the type
# name it is stored under. ``char[]`` is text of fixed length, ``length`` an array's length.
CELL_KINDS = [
    "raw", "boolean", "string", "char", "char[]", "length",
    "int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64", "float", "double",
]
STORED_NAMES = {"char[]": "char", "length": "int64"}
CODE = {name: code for code, name in enumerate(CELL_KINDS)}

# Fixed values of the log format: bytes per primitive.
WIDTHS = {
    "bool": 1, "char": 1,
    "int8": 1, "int16": 2, "int32": 4, "int64": 8,
    "uint8": 1, "uint16": 2, "uint32": 4, "uint64": 8,
    "float": 4, "float32": 4, "double": 8, "float64": 8,
}


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def reversed_bytes(data: Column, width: int, start: Column | int = 1) -> Column:
    first = F.lit(start) if isinstance(start, int) else start
    one = F.lit(1)
    return F.concat(*[F.substring(data, first + F.lit(i), one) for i in reversed(range(width))])


def le_unsigned(data: Column, width: int, start: Column | int = 1) -> Column:
    """Unsigned little-endian integer of up to four bytes, as BIGINT."""
    return F.conv(F.hex(reversed_bytes(data, width, start)), 16, 10).cast("bigint")


def le_hex(data: Column) -> Column:
    """Hex digits of a little-endian value of one to eight bytes, highest first.

    ``substring`` past the end is empty, so one form serves every width.
    """
    return F.hex(reversed_bytes(data, 8))


def bits_of_hex(digits: Column) -> Column:
    """The bits as BIGINT: eight bytes as a signed number, fewer ones zero-extended."""
    return F.conv(digits, 16, -10).cast("bigint")


def uint64_of_hex(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def signed(bits: Column, width: Column) -> Column:
    """Zero-extended bits of a ``width``-byte integer as a signed number."""
    spare = F.lit(64) - width * F.lit(8)
    return F.call_function("shiftright", F.call_function("shiftleft", bits, spare), spare)


def _weights(exp_bits: int, frac_bits: int) -> list[float]:
    """Weight of the last fraction bit, by sign and exponent; infinite for the top exponent."""
    top, bias = (1 << exp_bits) - 1, (1 << (exp_bits - 1)) - 1
    sizes = [2.0 ** (max(e, 1) - bias - frac_bits) for e in range(top)] + [float("inf")]
    return sizes + [-w for w in sizes]


_WEIGHTS = ",".join(str(w).replace("inf", "Infinity") for w in _weights(11, 52) + _weights(8, 23))


def with_real(df: DataFrame, name: str, bits: Column, is_double: Column) -> DataFrame:
    """Add the IEEE-754 value of its bits: mantissa times the weight of its last bit.

    Both factors are exact and so is their product. The weights come from a constant array
    indexed by sign and exponent, which keeps the generated code small enough for the JIT
    compiler; one form serves both widths.
    """
    pick = lambda double, single: F.when(is_double, F.lit(double)).otherwise(F.lit(single))
    top = F.call_function("shiftright", bits, pick(52, 23)).bitwiseAND(pick(4095, 511).cast("bigint"))
    at = top.cast("int") + pick(0, 4096)
    # one text literal that the optimizer folds into a constant array
    weight = F.get(F.split(F.lit(_WEIGHTS), ",").cast("array<double>"), F.col("_at"))
    normal = F.col("_at").bitwiseAND(pick(2047, 255)) > 0
    nan = (F.col("_fraction") > 0) & (F.abs(weight) == float("inf"))
    mantissa = F.col("_fraction") + F.when(normal, pick(1 << 52, 1 << 23)).otherwise(F.lit(0).cast("bigint"))
    return (
        df.withColumn("_at", at)
        .withColumn("_fraction", bits.bitwiseAND(pick((1 << 52) - 1, (1 << 23) - 1)))
        .withColumn(name, F.when(nan, float("nan")).otherwise(mantissa.cast("double") * weight))
        .drop("_at", "_fraction")
    )


def real(bits: Column, is_double: Column) -> Column:
    """The value of ``with_real`` as one expression, where no column can be added (inside lambdas)."""
    pick = lambda double, single: F.when(is_double, F.lit(double)).otherwise(F.lit(single))
    top = F.call_function("shiftright", bits, pick(52, 23)).bitwiseAND(pick(4095, 511).cast("bigint"))
    at = top.cast("int") + pick(0, 4096)
    fraction = bits.bitwiseAND(pick((1 << 52) - 1, (1 << 23) - 1))
    weight = F.get(F.split(F.lit(_WEIGHTS), ",").cast("array<double>"), at)
    hidden = F.when(at.bitwiseAND(pick(2047, 255)) > 0, pick(1 << 52, 1 << 23)).otherwise(F.lit(0).cast("bigint"))
    nan = (fraction > 0) & (F.abs(weight) == float("inf"))
    return F.when(nan, float("nan")).otherwise((fraction + hidden).cast("double") * weight)


def utf8_lossy(data: Column) -> Column:
    """UTF-8 text with U+FFFD for every bad sequence."""
    return F.make_valid_utf8(data.cast("string"))
