"""Continuous reassembly of flows of any size, with what was lost.

Two stateful operators are chained in append mode. The first, keyed by flow and part (a stretch of counters), holds
payloads until the part is full or nothing has come for a while, and says which pieces came when. The second, keyed by
flow, sees no payloads: from the arrivals it judges the flow by the rules of ``stream_reassemble``. No entry of state holds
more than the payloads of a part, or a few bytes per piece of a flow. Both run in buckets of keys; see ``together``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from flowtables.functions import binary, headers
from flowtables.functions.times import epoch_millis
from flowtables.operators.ordered import counter_block
from flowtables.operators.timeouts import FLUSH_PIECES, TIMEOUT
from flowtables.schema import ERROR, FLOW_KEY, SUCCESS, datagram_profile
from flowtables.streaming.reassembly import FlowAssembler
from flowtables.streaming.together import BUCKETS, Together, bucket_of

PART_PIECES = 2048
#: Rows that are no part of a content: the verdict on a flow, and what it lost.
VERDICT_PART, LOSS_PART = -1, -2
_NOTE_COLUMNS = (
    "lane", "part_no", "counters", "lengths", "content", "arrivals", "n", "payload_length", "header", "said_ms", "said_seq",
    "repeated", "unknown", "event_ts",
)
_NOTE = (
    "lane long, part_no long, counters array<long>, lengths array<long>, content binary, arrivals array<long>, n long, "
    "payload_length long, header string, said_ms long, said_seq long, repeated long, unknown long, event_ts timestamp"
)
_RESULT_COLUMNS = (
    "part_no", "counters", "lengths", "content", "n", "payload_length", "header", "size", "verdict", "repeated", "late",
    "orphaned", "unknown",
)
_RESULT = (
    "part_no long, counters array<long>, lengths array<long>, content binary, n long, payload_length long, header string, "
    "size long, verdict string, repeated long, late long, orphaned long, unknown long"
)


def _moment(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, tz=timezone.utc)


class PartHolder(StatefulProcessor):
    """Payloads of one part. Pieces that come after a part was given out are given out in turn."""

    def __init__(self, key: Sequence[str], timeout_ms: int, keep_ms: int, part_pieces: int, extra: int):
        self.note = Row(*key, *_NOTE_COLUMNS)
        self.timeout_ms, self.keep_ms, self.part_pieces, self.extra = timeout_ms, keep_ms, part_pieces, extra

    def init(self, handle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "seen binary, latest long, held long")
        self.held = handle.getListState("held", "counter long, payload binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *flow, part_no = key
        if part_no < 0:  # not a piece
            rows = list(rows)
            yield self._row(flow, timerValues, max(r.arrival_ms for r in rows), lane=LOSS_PART, part_no=LOSS_PART, unknown=len(rows))
            return
        known = self.meta.exists()
        seen, latest, held = self.meta.get() if known else (bytes(self.part_pieces), 0, 0)
        seen = bytearray(seen)
        first: dict[int, int] = {}
        fresh: dict[int, tuple] = {}
        sizes: dict[int, int] = {}
        said, repeated = None, 0
        for row in rows:
            counter, own = int(row.counter), (row.arrival_ms, row.arrival_seq)
            sizes[counter] = len(row.payload)
            latest = max(latest, row.arrival_ms)
            first[counter] = min(first.get(counter, row.arrival_ms), row.arrival_ms)
            if row.header_type == 0 and (said is None or own >= said[:2]):
                said = (*own, int(row.n_datagrams) + self.extra, int(row.payload_length), row.header)
            if seen[counter % self.part_pieces]:
                repeated += 1
                if counter in fresh and own > fresh[counter][0]:
                    fresh[counter] = (own, bytes(row.payload))
            else:
                seen[counter % self.part_pieces] = 1
                fresh[counter] = (own, bytes(row.payload))
        counters = sorted(first)
        # Lengths of pieces seen before are told below zero.
        lengths = [len(fresh[c][1]) if c in fresh else -1 - sizes[c] for c in counters]
        announced = {} if said is None else dict(zip(("said_ms", "said_seq", "n", "payload_length", "header"), said))
        yield self._row(
            flow, timerValues, latest, lane=0, part_no=part_no, counters=counters, arrivals=[first[c] for c in counters],
            lengths=lengths, repeated=repeated, **announced,
        )
        pieces = [(c, p) for c, (_, p) in fresh.items()]
        if all(seen) and (held or pieces):
            yield self._out(flow, part_no, timerValues, latest, self._stored(held) + pieces)
            if held:
                self.held.clear()
            held = 0
        elif pieces:
            self.held.appendList(pieces)
            held += len(pieces)
        self.meta.update((bytes(seen), latest, held))
        self._set_timer(known, latest + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        *flow, part_no = key
        seen, latest, held = self.meta.get()
        now = timerValues.getCurrentWatermarkInMs()
        if held:
            yield self._out(flow, part_no, timerValues, now, self._stored(held))
            self.held.clear()
            self.meta.update((seen, latest, 0))
        # What came is remembered for a while, so that copies are known as such.
        if latest + self.keep_ms > now:
            self._set_timer(True, latest + self.keep_ms)
        else:
            self.meta.clear()

    def close(self) -> None:
        pass

    def _stored(self, held: int) -> list[tuple]:
        return [(c, bytes(p)) for c, p in self.held.get()] if held else []

    def _out(self, flow, part_no: int, timerValues, at: int, pieces: list[tuple]) -> Row:
        pieces.sort()
        return self._row(
            flow, timerValues, at, lane=part_no + 1, part_no=part_no, counters=[c for c, _ in pieces],
            lengths=[len(p) for _, p in pieces], content=b"".join(p for _, p in pieces),
        )

    def _row(self, flow, timerValues, at: int, **values) -> Row:
        values["event_ts"] = _moment(max(at, timerValues.getCurrentWatermarkInMs()))
        return self.note(*flow, *(values.get(c) for c in _NOTE_COLUMNS))

    def _set_timer(self, known: bool, at: int) -> None:
        for timer in list(self.handle.listTimers()) if known else ():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(at))


class FlowJudge(FlowAssembler):
    """The verdict on a flow, from the arrivals of its pieces; an entry of state per part."""

    def __init__(self, key: Sequence[str], timeout_ms: int, keep_ms: int, flush_pieces: int, part_pieces: int):
        super().__init__(key, timeout_ms, keep_ms, 1 << 62, flush_pieces, 0)
        self.result = Row(*key, *_RESULT_COLUMNS)
        self.part_pieces = part_pieces

    def init(self, handle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "part_no long", "first binary, lengths binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *flow, lane = key
        if lane:
            for row in rows:
                yield self._out(flow, part_no=row.part_no, counters=row.counters, lengths=row.lengths, content=row.content, unknown=row.unknown)
            return
        self._load()
        self._arrays: dict[int, tuple] = {}
        n_before, latest, repeated, late, new = self.n, 0, 0, 0, []
        for row in rows:
            repeated += row.repeated
            latest = max(latest, *row.arrivals)
            if row.said_ms is not None and not self.closed:
                said = (row.said_ms, row.said_seq)
                if self.n is None or said >= (self.said_ms, self.said_seq):
                    self.n, self.payload_length, self.header = row.n, row.payload_length, row.header
                    self.said_ms, self.said_seq = said
            first, lengths = self._part(row.part_no, create=not self.closed)
            for counter, at, length in zip(row.counters, row.arrivals, row.lengths):
                place = counter - row.part_no * self.part_pieces
                if self.closed:
                    late += length >= 0
                elif first[place] < 0:
                    first[place], lengths[place] = at, length if length >= 0 else -1 - length
                    new.append(counter)
                else:
                    first[place] = min(first[place], at)
        if repeated or late:
            yield self._out(flow, part_no=LOSS_PART, repeated=repeated, late=late)
        if self.closed:
            return
        if self.n is not None and self.n != n_before:
            self.count = self._sum(lambda first, lengths: (first >= 0).sum())
        elif self.n is not None:
            self.count += sum(c < self.n for c in new)
        if self.n is not None and 0 < self.n == self.count and self._walk(self._stored_piece)[0] == self.n:
            yield self._verdict(flow, SUCCESS)
            self._close(latest)
            return
        for part_no, (first, lengths) in self._arrays.items():
            self.parts.updateValue((part_no,), (first.tobytes(), lengths.tobytes()))
        begun = self._stored_piece(0)
        if self.at == 0 and begun is not None:
            self.deadline = begun[0] + self.timeout_ms
        self._save()
        self._set_timer(latest + self.timeout_ms if self.n is None else self.deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        *flow, _ = key
        self._load()
        self._arrays = {}
        if self.closed:
            self.meta.clear()
            return
        if self.n is None:
            yield self._out(flow, part_no=LOSS_PART, orphaned=int(self._sum(lambda first, lengths: (first >= 0).sum(), whole=True)))
            self.parts.clear()
            self.meta.clear()
            return
        now = timerValues.getCurrentWatermarkInMs()
        self.at, self.usable, self.left, self.deadline = self._walk(self._stored_piece, now)
        if self.deadline > now:
            self._save()
            self._set_timer(self.deadline)
            return
        yield self._verdict(flow, TIMEOUT)
        late = self._sum(lambda first, lengths: (first > self.deadline).sum())
        if late:
            yield self._out(flow, part_no=LOSS_PART, late=late)
        self._close(now)

    def _part(self, part_no: int, create: bool = True) -> tuple[np.ndarray, np.ndarray] | None:
        if part_no not in self._arrays:
            known = self.parts.getValue((part_no,)) if self.stored and self.parts.containsKey((part_no,)) else None
            if known is not None:
                self._arrays[part_no] = tuple(np.frombuffer(bytes(b), np.int64).copy() for b in known)
            elif create:
                self._arrays[part_no] = np.full(self.part_pieces, -1, np.int64), np.zeros(self.part_pieces, np.int64)
            else:
                return None, None
        return self._arrays[part_no]

    def _stored_piece(self, counter: int) -> tuple | None:
        first, _ = self._part(counter // self.part_pieces, create=False)
        at = -1 if first is None else int(first[counter % self.part_pieces])
        return None if at < 0 else (at,)

    def _sum(self, of, whole: bool = False) -> int:
        """A sum over all parts, of the flow's own pieces."""
        if self.stored:
            for (part_no,) in list(self.parts.keys()):
                self._part(part_no)
        total = 0
        for part_no, (first, lengths) in self._arrays.items():
            own = self.part_pieces if whole else max(0, min(self.part_pieces, self.n - part_no * self.part_pieces))
            total += int(of(first[:own], lengths[:own]))
        return total

    def _verdict(self, flow, verdict: str) -> Row:
        size = self._sum(lambda first, lengths: lengths.sum()) if verdict == SUCCESS else None
        return self._out(
            flow, part_no=VERDICT_PART, n=self.n, payload_length=self.payload_length, header=self.header, size=size, verdict=verdict
        )

    def _close(self, at: int) -> None:
        if self.stored:
            self.parts.clear()
        self.closed, self.deadline = True, at
        self._save()
        self._set_timer(at + self.keep_ms)

    def _out(self, flow, **values) -> Row:
        return self.result(*flow, *(values.get(c) for c in _RESULT_COLUMNS))


def stream_reassemble_parts(
    datagrams: DataFrame,
    timeout_ms: int = 2000,
    watermark: str = "10 minutes",
    key: Sequence[str] = FLOW_KEY,
    at: str = "arrival_ts",
    profile: str = "v0",
    keep_ms: int = 600_000,
    flush_pieces: int = FLUSH_PIECES,
    part_pieces: int = PART_PIECES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """O34 for flows of any size: pieces of content by part, verdicts and losses as they come, in one table.

    Rows with ``part_no`` from 0 on are contents: ``counters`` and ``lengths`` of the pieces that lie in ``content``.
    Part -1 is the verdict on a flow, ``success`` or ``timeout``, by the rules of :func:`stream_reassemble`. Part -2 counts
    losses: ``repeated`` pieces, those too ``late`` (they came after their flow's deadline or after its verdict), ``orphaned``
    ones of flows never announced, and ``unknown`` datagrams that are no piece. :func:`reassembled_parts` and :func:`datagram_losses` read them.
    """
    order = F.col("arrival_seq") if "arrival_seq" in datagrams.columns else F.lit(0).cast("bigint")
    is_piece = ((F.col("header_type") == 0) & (F.col("counter") == 0)) | ((F.col("header_type") == 1) & (F.col("counter") > 0))
    never = F.col(at) < F.lit("0001-01-01").cast("timestamp")
    wanted = (
        datagrams.withColumn("arrival_ms", epoch_millis(datagrams, at))
        .withColumn("arrival_seq", order)
        .withColumn("part_no", F.when(F.coalesce(is_piece, F.lit(False)), counter_block(size=part_pieces)).otherwise(LOSS_PART))
        .withWatermark(at, watermark)
        .select(
            *key, "part_no", "header_type", "counter", "n_datagrams", "payload_length", "header",
            F.coalesce("payload", F.unhex(F.lit(""))).alias("payload"), "arrival_ms", "arrival_seq", at,
        )
        # Keepalives move the watermark only; see stream_reassemble.
        .filter((F.col("header_type") != 3) | F.col("header_type").isNull() | never)
    )
    key_schema = ", ".join(f"`{c}` {datagrams.schema[c].dataType.simpleString()}" for c in key)
    extra = 0 if datagram_profile(profile).announces_first else 1
    part_key = [*key, "part_no"]
    notes = wanted.withColumn("_bucket", bucket_of(part_key, buckets)).groupBy("_bucket").transformWithState(
        statefulProcessor=Together(PartHolder(key, timeout_ms, keep_ms, part_pieces, extra), part_key),
        outputStructType=f"{key_schema}, {_NOTE}",
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="event_ts",
    )
    # Contents go by part, each in a lane of its own; what is judged goes by flow.
    lanes = F.when(F.col("lane") == 0, bucket_of(key, buckets)).otherwise(buckets + bucket_of([*key, "lane"], buckets))
    return notes.withColumn("_bucket", lanes).groupBy("_bucket").transformWithState(
        statefulProcessor=Together(FlowJudge(key, timeout_ms, keep_ms, flush_pieces, part_pieces), [*key, "lane"]),
        outputStructType=f"{key_schema}, {_RESULT}",
        outputMode="Append",
        timeMode="EventTime",
    )


def reassembled_parts(rows: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """Flows from a table of :func:`stream_reassemble_parts`, by part as :func:`reassemble_parts` gives them.

    A flow that failed is one row with part 0 and no content. Payloads are joined and grouped by part only.
    """
    key = list(key)
    part_key = [*key, "part_no"]
    flows = rows.filter(F.col("part_no") == VERDICT_PART).select(*key, "n", "payload_length", "header", "size", "verdict")
    flows = flows.withColumn("attributes", headers.header_attributes(F.col("header")))
    bad_header = (F.octet_length("header") > 0) & F.col("attributes").isNull()
    flows = flows.withColumn("reason", F.when(F.col("verdict") != SUCCESS, F.col("verdict")).when(bad_header, "bad_header"))
    good = F.col("reason").isNull()
    # A part may have been given out in several rows: pieces are cut from them and put in order, each once.
    places = rows.filter(F.col("part_no") >= 0).select(
        *part_key, "content", F.posexplode("counters").alias("i", "counter"), "lengths"
    )
    before = F.aggregate(F.slice("lengths", 1, F.col("i")), F.lit(0).cast("bigint"), lambda total, n: total + n)
    pieces = places.select(
        *part_key, "counter", binary.slice_bytes(F.col("content"), before, F.element_at("lengths", F.col("i") + 1)).alias("piece")
    ).dropDuplicates([*part_key, "counter"])
    block = F.sequence(F.lit(0).cast("bigint"), F.when(good, F.greatest(F.col("last"), F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint")))
    numbers = rows.filter(F.col("part_no") >= 0).groupBy(*key).agg(F.max("part_no").alias("last"))
    wanted = flows.join(numbers, key, "left").select(
        *key, "n", "payload_length", "size", "reason", "attributes", F.explode(block).alias("part_no")
    )
    own = pieces.join(wanted.filter(good).select(*part_key, "n"), part_key).filter(F.col("counter") < F.col("n"))
    bodies = own.groupBy(*part_key).agg(F.expr("listagg(piece) within group (order by counter)").alias("body"))
    return (
        wanted.join(bodies, part_key, "left")
        .filter(~good | (F.col("part_no") == 0) | F.col("body").isNotNull())
        .select(
            *part_key,
            F.when(good, F.coalesce("body", F.unhex(F.lit("")))).alias("content"),
            F.when(good & (F.col("part_no") == 0), F.col("attributes")).alias("attributes"),
            F.when(good, F.col("size")).alias("size"),
            F.when(good, SUCCESS).otherwise(ERROR).alias("outcome"),
            "reason",
            F.when(good, F.col("size") == F.col("payload_length")).alias("length_ok"),
        )
    )


def datagram_losses(rows: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """Per flow that lost any: ``repeated``, ``late``, ``orphaned`` pieces and ``unknown`` datagrams."""
    kinds = ("repeated", "late", "orphaned", "unknown")
    lost = rows.filter(F.col("part_no") == LOSS_PART)
    return lost.groupBy(*key).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kinds))
