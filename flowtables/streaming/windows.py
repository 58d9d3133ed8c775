"""Declarative streams: dedupe, throughput, idle sessions (O36-O38). All also run on static DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.schema import FLOW_KEY, datagram_profile


def stream_dedupe(
    datagrams: DataFrame, delay: str = "10 minutes", key: Sequence[str] = FLOW_KEY, at: str = "arrival_ts"
) -> DataFrame:
    """O38. Drop repeats of a (flow, counter) that come within ``delay``. The first one wins; repeats are identical."""
    return datagrams.withWatermark(at, delay).dropDuplicatesWithinWatermark([*key, "counter"])


def stream_throughput(
    datagrams: DataFrame,
    window: str = "1 minute",
    slide: str | None = None,
    watermark: str = "10 minutes",
    at: str = "arrival_ts",
    profile: str = "v0",
) -> DataFrame:
    """O37. Datagrams, bytes, packets per second and Mbit per second in tumbling or sliding windows.

    Keepalives and packets of unknown types move the watermark but are not counted.
    """
    data_header = datagram_profile(profile).data_header
    # No filter on the type: it would be pushed below the watermark.
    counted = F.col("header_type").isin(0, 1)
    size = F.when(counted, F.octet_length("payload") + F.when(F.col("header_type") == 1, data_header).otherwise(0))
    span = F.window(at, window, slide) if slide else F.window(at, window)
    sums = (
        datagrams.withWatermark(at, watermark)
        .groupBy(span.alias("window"))
        .agg(F.count(F.when(counted, 1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
        .filter("n > 0")
    )
    seconds = (F.unix_millis("window.end") - F.unix_millis("window.start")) / 1000.0
    return sums.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "n",
        "bytes",
        (F.col("n") / seconds).alias("pps"),
        (F.col("bytes") * 8 / seconds / 1_000_000).alias("mbit"),
    )


def stream_raw_sessions(
    segments: DataFrame,
    conn: str = "conn_id",
    at: str = "ts",
    order: str = "seq",
    idle: str = "5 seconds",
    watermark: str = "10 minutes",
    content: bool = True,
) -> DataFrame:
    """O36. The bytes of a connection up to a pause of ``idle`` are one flow: ``start, end, n, size, content``.

    ``content=False`` keeps only the totals, for connections that may send more than a cell can hold.
    """
    measures = [F.count("*").alias("n"), F.sum(F.octet_length("bytes").cast("bigint")).alias("size")]
    if content:
        measures.append(F.expr(f"listagg(bytes) within group (order by `{order}`)").alias("content"))
    sessions = (
        segments.withWatermark(at, watermark).groupBy(conn, F.session_window(at, idle).alias("session")).agg(*measures)
    )
    return sessions.select(
        conn,
        F.col("session.start").alias("start"),
        F.col("session.end").alias("end"),
        "n",
        "size",
        *(["content"] if content else []),
    )
