"""Stalled writes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.operators.datagrams import announcements, contiguous_arrivals, first_arrivals
from flowtables.operators.ordered import counter_block
from flowtables.schema import FLOW_KEY, SUCCESS

TIMEOUT = "timeout"

# Fixed value: the writer flushes once this many pieces are ready in order.
FLUSH_PIECES = 1001

_SPAN = 1 << 20  # counters per span of a long flow


def classify_timeouts(
    datagrams: DataFrame,
    timeout_ms: int = 2000,
    key: Sequence[str] = FLOW_KEY,
    at: str = "arrival_ts",
    profile: str = "v0",
    flush_pieces: int = FLUSH_PIECES,
    span: int = _SPAN,
) -> DataFrame:
    """O27. ``outcome`` of each announced flow: ``success``, or ``timeout`` if writing stalls longer than the limit.

    The clock starts with piece 0 and moves only when pieces are written: when all have come, or when
    ``flush_pieces`` more are ready in order. A flow that fits one flush only needs its last piece in time.
    Longer flows go span by span: each span is walked once for every possible number of waiting pieces, and
    the spans of a flow are then chained, so no task sees all pieces of a flow.
    """
    key = list(key)
    announced = announcements(datagrams, key, profile).select(*key, "n")
    small, large = announced.filter(F.col("n") <= flush_pieces), announced.filter(F.col("n") > flush_pieces)

    began = F.max(F.when(F.col("counter") == 0, F.col("first_ms")))
    one_flush = (
        first_arrivals(datagrams.filter(F.col("counter") < flush_pieces), key, at)
        .join(small, key)
        .filter(F.col("counter") < F.col("n"))
        .groupBy(*key)
        .agg(F.count("*").alias("pieces"), F.max("n").alias("n"), (F.max("first_ms") - began).alias("took"))
        .filter((F.col("pieces") == F.col("n")) & (F.col("took") <= timeout_ms))
        .select(*key)
    )
    # Joined block by block, so that no long flow meets its own announcement in one task.
    last_block = counter_block(F.col("n") - 1)
    blocks = large.select(*key, "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"))
    pieces = first_arrivals(datagrams, key, at).withColumn("block", counter_block())
    many = contiguous_arrivals(pieces.join(blocks, [*key, "block"]).filter(F.col("counter") < F.col("n")), key)
    chained = _chained_in_time(many, key, timeout_ms, flush_pieces, span)
    in_time = one_flush.unionByName(chained)
    return announced.join(in_time.withColumn("_ok", F.lit(True)), key, "left").select(
        *key, F.when(F.col("_ok"), SUCCESS).otherwise(TIMEOUT).alias("outcome")
    )


def _chained_in_time(progress: DataFrame, key: list[str], timeout_ms: int, flush_pieces: int, span: int) -> DataFrame:
    # One point per moment at which more pieces became usable, placed by the last of them.
    points = progress.groupBy(*key, "n", "usable_ms").agg(F.max("counter").alias("last")).withColumn(
        "span", counter_block("last", span)
    )
    spans = points.groupBy(*key, "span").agg(F.max("last").alias("end"))
    before = Window.partitionBy(*key).orderBy("span")
    starts = spans.select(*key, "span", F.coalesce(F.lag("end").over(before), F.lit(-1)).alias("start"))
    walked = (
        points.join(starts, [*key, "span"])
        .groupBy(*key, "span")
        .applyInPandas(
            lambda pdf: _walk_span(pdf, key, flush_pieces),
            schema=", ".join(
                [f"`{c}` {points.schema[c].dataType.simpleString()}" for c in key]
                + ["span long, done boolean, leaves array<int>, first_ms array<long>, last_ms array<long>, worst array<long>"]
            ),
        )
    )
    verdicts = walked.groupBy(*key).applyInPandas(
        lambda pdf: _chain_spans(pdf, key, timeout_ms),
        schema=", ".join([f"`{c}` {points.schema[c].dataType.simpleString()}" for c in key] + ["ok boolean"]),
    )
    return verdicts.filter("ok").select(*key)


def _walk_span(pdf: pd.DataFrame, key: list[str], flush_pieces: int) -> pd.DataFrame:
    """Flush times in one span, for each number of pieces that may be waiting when it begins."""
    pdf = pdf.sort_values("last")
    last, at = pdf["last"].to_numpy(), pdf["usable_ms"].to_numpy()
    n, start = int(pdf["n"].iloc[0]), int(pdf["start"].iloc[0])
    states = 1 if start < 0 else flush_pieces
    left = start + 1 - np.arange(states, dtype=np.int64)  # first piece not yet written
    first = np.full(states, -1, dtype=np.int64)
    latest = np.full(states, -1, dtype=np.int64)
    worst = np.zeros(states, dtype=np.int64)
    done = bool(last[-1] == n - 1)
    while True:
        point = np.searchsorted(last, left + flush_pieces - 1)
        if done:
            point = np.where(left < n, np.minimum(point, len(last) - 1), len(last))
        hit = point < len(last)
        if not hit.any():
            break
        when = at[point[hit]]
        gap = np.where(latest[hit] >= 0, when - latest[hit], 0)
        worst[hit] = np.maximum(worst[hit], gap)
        first[hit] = np.where(first[hit] >= 0, first[hit], when)
        latest[hit] = when
        left[hit] = last[point[hit]] + 1
    row = {c: pdf[c].iloc[0] for c in key}
    row |= {
        "span": pdf["span"].iloc[0],
        "done": done,
        "leaves": (last[-1] + 1 - left).astype(np.int32),
        "first_ms": first if start >= 0 else np.append(first, at[0]),  # piece 0 starts the clock
        "last_ms": latest,
        "worst": worst,
    }
    return pd.DataFrame([row])


def _chain_spans(pdf: pd.DataFrame, key: list[str], timeout_ms: int) -> pd.DataFrame:
    pdf = pdf.sort_values("span")
    waiting, clock, ok = 0, None, bool(pdf["done"].any())
    for spans in pdf.itertuples():
        if clock is None:
            clock = spans.first_ms[-1]
        first, last = spans.first_ms[waiting], spans.last_ms[waiting]
        if first >= 0:
            ok = ok and first - clock <= timeout_ms and spans.worst[waiting] <= timeout_ms
            clock = last
        waiting = int(spans.leaves[waiting])
    return pd.DataFrame([{c: pdf[c].iloc[0] for c in key} | {"ok": ok}])
