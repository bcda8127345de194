"""Integer and rounding semantics that quantised terrain depends on, safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """Truncation towards zero; NaN is 0 and what lies beyond an int is its limit."""
    return F.when(F.isnan(c), 0).when(c >= 2147483647.0, 2147483647).when(c <= -2147483648.0, -2147483648).otherwise(c.cast("int"))


def floor_int(c: Column) -> Column:
    return to_int(F.floor(c).cast("double"))


def half_up(c: Column) -> Column:
    """The nearest integer, halves upward."""
    return F.floor(c + 0.5)


def wrap16(c: Column) -> Column:
    """The signed 16-bit value of an integer's low bits."""
    return (c + 32768).bitwiseAND(F.lit(65535)) - 32768


def zigzag(c: Column) -> Column:
    """Signed 16-bit to unsigned, small magnitudes first."""
    return F.shiftleft(c, 1).bitwiseXOR(F.shiftright(c, 15)).bitwiseAND(F.lit(65535))


def unzigzag(c: Column) -> Column:
    return F.shiftright(c, 1).bitwiseXOR(-c.bitwiseAND(F.lit(1)))


def cut(c: Column) -> Column:
    """Floor at eight decimals."""
    return F.floor(c * 1e8) / 1e8


def byte_size(c: Column) -> Column:
    """A count of bytes as whole GB, MB, KB or bytes."""
    of = lambda k, name: F.concat((c / (1 << k)).cast("long").cast("string"), F.lit(name))
    return F.when(c >= 1 << 30, of(30, "GB")).when(c >= 1 << 20, of(20, "MB")).when(c >= 1 << 10, of(10, "KB")).otherwise(F.concat(c.cast("string"), F.lit("bytes")))


def power_of_two_up(c: Column) -> Column:
    return F.pow(F.lit(2.0), F.ceil(F.log2(c))).cast("int")
