"""Big-endian integers in binary columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int64_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def int32_bytes(value: Column) -> Column:
    return F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(8)))


def int64_at(data: Column, position: int) -> Column:
    """Signed 64-bit integer whose first byte is at 1-based ``position``."""
    return F.conv(F.hex(F.substring(data, position, 8)), 16, -10).cast("bigint")


def int32_at(data: Column, position: int) -> Column:
    """Signed 32-bit integer whose first byte is at 1-based ``position``."""
    unsigned = F.conv(F.hex(F.substring(data, position, 4)), 16, 10).cast("bigint")
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned)


def slice_bytes(data: Column, offset: Column, length: Column) -> Column:
    """``length`` bytes from 0-based ``offset``."""
    return F.substring(data, (offset + 1).cast("int"), length.cast("int"))


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")
