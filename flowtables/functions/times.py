"""Timestamps as numbers, whatever their type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without time zone is not shifted into any."""
    column = F.col(name)
    if df.schema[name].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(column)
    seconds = (F.unix_date(F.to_date(column)).cast("bigint") * 24 + F.hour(column)) * 3600 + F.minute(column) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds of a timestamp column; a numeric column already holds them."""
    if df.schema[name].dataType.typeName().startswith("timestamp"):
        return F.floor(epoch_micros(df, name) / F.lit(1000)).cast("bigint")
    return F.col(name).cast("bigint")
