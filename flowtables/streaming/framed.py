"""Continuous decoding of framed connections.

``stream_frame_parts`` is one stateful operator in append mode, keyed by connection. It follows the frames, keeps the bytes
of the one part that is open and gives a part out when all of it is there; it closes a connection at its last segment, or
when nothing has come for ``idle``. So what a key holds is bounded by a part and by the segments that came too early,
whatever the size of a flow or a connection, and nothing is left of it when it is over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from flowtables.functions import headers
from flowtables.functions.times import epoch_millis
from flowtables.operators.framecutter import FrameCutter
from flowtables.schema import ERROR, SUCCESS, frame_prefix_bytes

#: Bytes of a payload in one part.
PART_BYTES = 4 << 20
#: Parts that are no stretch of a payload: a frame's header, its end, and what a connection lost.
HEADER_PART, END_PART, LOSS_PART = -1, -2, -3

_STATE = f"next long, {FrameCutter.STATE_SCHEMA}"


class ConnectionCutter(StatefulProcessor):
    """Remembers where in its frame a connection stands, and segments that came too early; never content."""

    def __init__(self, conn: str, prefix: int):
        self.conn, self.prefix = conn, prefix

    def init(self, handle) -> None:
        self.place = handle.getValueState("place", _STATE)
        self.early = handle.getMapState("early", "seq long", "bytes binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.place.get() if self.place.exists() else None
        expected = known[0] if known else 0
        cutter = FrameCutter(self.prefix, (*known[1:5], bytes(known[5]), known[6]) if known else None)
        waiting: dict[int, bytes] = {}
        for batch in rows:
            for seq, data in zip(batch["seq"], batch["bytes"]):
                if seq >= expected:
                    waiting[int(seq)] = bytes(data)
            pieces = []
            while expected in waiting or (known and self.early.containsKey((expected,))):
                data = waiting.pop(expected, None)
                if data is None:
                    data = bytes(self.early.getValue((expected,))[0])
                    self.early.removeKey((expected,))
                pieces += cutter.feed(data)
                expected += 1
            if pieces:
                out = pd.DataFrame(pieces, columns=list(FrameCutter.FIELDS))
                for name in ("header_len", "payload_len"):
                    out[name] = out[name].astype("Int64")
                out.insert(0, self.conn, key[0])
                yield out
        for seq, data in waiting.items():
            self.early.updateValue((seq,), (data,))
        self.place.update((expected, *cutter.state()))

    def close(self) -> None:
        pass


def stream_cut_frames(segments: DataFrame, conn: str = "conn_id", seq: str = "seq", profile: str = "v2") -> DataFrame:
    """O35. The frame pieces of a stream of segments, as ``cut_frames`` gives them for a table.

    Segments of a connection are numbered 0, 1, 2 ... and may come out of order. Land the pieces and give them to
    ``assemble_frames`` for flows: contents are gathered there, not in the state of the stream.
    """
    conn_type = segments.schema[conn].dataType.simpleString()
    return (
        segments.select(conn, segments[seq].cast("bigint").alias("seq"), "bytes")
        .groupBy(conn)
        .transformWithStateInPandas(
            statefulProcessor=ConnectionCutter(conn, frame_prefix_bytes(profile)),
            outputStructType=f"`{conn}` {conn_type}, {FrameCutter.SCHEMA}",
            outputMode="Append",
            timeMode="None",
        )
    )


_PARTS = (
    "frame_no long, part_no long, content binary, size long, reason string, truncated boolean, repeated long, lost long"
)
_LIVE = f"next long, {FrameCutter.STATE_SCHEMA}, last_ms long, closed boolean, repeated long"
#: Bytes that are cut, written to state or given out together.
_TOGETHER = 4 << 20


class FlowCutter(StatefulProcessor):
    """Cuts a connection into parts, frame ends and, when it closes, what is left open.

    A connection is cut in order, so only one part of it is open at a time: its bytes are kept, together with segments that
    came too early. Those are kept in runs of neighbours, so that state is read and written by run and batch, not by segment.
    """

    COLUMNS = [c.split()[0] for c in _PARTS.split(", ")]

    def __init__(self, conn: str, prefix: int, idle_ms: int, part_bytes: int):
        self.conn, self.prefix, self.idle_ms, self.part_bytes = conn, prefix, idle_ms, part_bytes

    def init(self, handle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", _LIVE)
        self.open = handle.getListState("open", "bytes binary")
        self.early = handle.getMapState("early", "first long", "bytes binary, lengths binary, closes binary")
        #: First numbers of the early runs, ascending, and their counts.
        self.runs = handle.getValueState("runs", "firsts binary, counts binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.live.get() if self.live.exists() else None
        for timer in list(self.handle.listTimers()) if known else ():
            self.handle.deleteTimer(timer)
        if known and known[7] + self.idle_ms <= timerValues.getCurrentWatermarkInMs():
            # It has been idle for too long by now: these are the first segments of another one.
            yield self._frame(key, self._expire(known))
            known = None
        expected, frames, last_ms, closed, repeated = (
            (known[0], (*known[1:5], bytes(known[5]), known[6]), *known[7:10]) if known else (0, None, 0, False, 0)
        )
        cutter, waiting = FrameCutter(self.prefix, frames), {}
        firsts, counts = self._early_runs(known)
        n_runs = len(firsts)
        for batch in rows:
            numbers = batch["seq"].to_numpy("int64")
            last_ms = max(last_ms, int(batch["ms"].max()))
            run = np.searchsorted(firsts, numbers, "right") - 1
            old = (numbers < expected) | closed
            if n_runs:
                old |= (run >= 0) & (numbers < (firsts + counts)[run])
            for seq, data, closes, is_old in zip(numbers.tolist(), batch["bytes"], batch["closes"], old.tolist()):
                if is_old or seq in waiting:
                    repeated += 1
                else:
                    waiting[seq] = (bytes(data or b""), bool(closes))
        self._begin_part(stored=known is not None)
        out, together, size, given, behind = [], [], 0, 0, 0
        following = {int(f): int(n) for f, n in zip(firsts, counts)}
        while not closed and (expected in waiting or expected in following):
            if expected in waiting:
                segments = [waiting.pop(expected)]
            else:
                segments = self._early_segments(expected)
                self.early.removeKey((expected,))
                del following[expected]
            for i, (data, closes) in enumerate(segments, 1):
                together.append(data)
                size += len(data)
                expected, closed = expected + 1, closes
                if size >= _TOGETHER or closed:
                    out += self._cut(cutter, b"".join(together))
                    given += size
                    together, size = [], 0
                if closed:
                    behind = len(segments) - i
                    break
            if given >= _TOGETHER and out:
                yield self._frame(key, out)
                out, given = [], 0
        if together:
            out += self._cut(cutter, b"".join(together))
        if closed and known and known[8]:  # only repeated segments have come since
            out += [self._loss(repeated, 0)] if repeated else []
            repeated = 0
        elif closed:
            out += self._close(cutter, repeated, behind + len(waiting) + sum(following.values()))
            repeated = 0
            if n_runs:
                self.early.clear()
                self.runs.clear()
        elif waiting or len(following) < n_runs:
            following |= self._keep_early(waiting)
            order = sorted(following)
            self.runs.update((np.array(order, np.int64).tobytes(), np.array([following[f] for f in order], np.int64).tobytes()))
        self._end_batch()
        self.live.update((expected, *cutter.state(), last_ms, closed, repeated))
        self.handle.registerTimer(last_ms + self.idle_ms)
        yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._frame(key, self._expire(self.live.get()))

    def close(self) -> None:
        pass

    def _expire(self, known) -> list[tuple]:
        if known[8]:  # closed before: only repeated segments have come since
            out = [self._loss(known[9], 0)] if known[9] else []
        else:
            cutter = FrameCutter(self.prefix, (*known[1:5], bytes(known[5]), known[6]))
            self._begin_part(stored=True)
            out = list(self._close(cutter, known[9], int(self._early_runs(known)[1].sum())))
            self.open.clear()
            self.early.clear()
            self.runs.clear()
        self.live.clear()
        return out

    # --- segments that came too early

    def _early_runs(self, known) -> tuple[np.ndarray, np.ndarray]:
        if not known or not self.runs.exists():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        firsts, counts = (np.frombuffer(bytes(b), np.int64) for b in self.runs.get())
        return firsts, counts

    def _early_segments(self, first: int) -> list[tuple[bytes, bool]]:
        data, lengths, closes = map(bytes, self.early.getValue((first,)))
        ends = np.cumsum(np.frombuffer(lengths, np.int64)).tolist()
        return [(data[begin:end], bool(c)) for begin, end, c in zip([0, *ends], ends, closes)]

    def _keep_early(self, waiting: dict[int, tuple[bytes, bool]]) -> dict[int, int]:
        kept, run, size = {}, [], 0
        for seq in sorted(waiting):
            if run and (seq != run[-1] + 1 or size >= _TOGETHER):
                kept[run[0]] = self._keep_run(run, waiting)
                run, size = [], 0
            run.append(seq)
            size += len(waiting[seq][0])
        if run:
            kept[run[0]] = self._keep_run(run, waiting)
        return kept

    def _keep_run(self, run: list[int], waiting: dict[int, tuple[bytes, bool]]) -> int:
        segments = [waiting[seq] for seq in run]
        lengths = np.array([len(data) for data, _ in segments], np.int64).tobytes()
        self.early.updateValue((run[0],), (b"".join(d for d, _ in segments), lengths, bytes(c for _, c in segments)))
        return len(run)

    # --- the part that is open

    def _begin_part(self, stored: bool) -> None:
        self._stored, self._fresh = stored, []

    def _end_batch(self) -> None:
        if self._fresh:
            self.open.appendValue((b"".join(self._fresh),))

    def _open_bytes(self) -> bytes:
        """The bytes of the open part, which is over."""
        before = []
        if self._stored:
            before = [bytes(b) for (b,) in self.open.get()]
            if before:
                self.open.clear()
            self._stored = False
        content = b"".join(before + self._fresh)
        self._fresh = []
        return content

    def _cut(self, cutter: FrameCutter, data: bytes) -> list[tuple]:
        out = []
        for frame_no, part, at, header_len, payload_len, piece in cutter.feed(data):
            if part == "X":
                out.append(self._end(frame_no, 0, "bad_length", False))
            elif part == "F" and payload_len is not None and header_len + payload_len == 0:
                out.append(self._end(frame_no, 0, None, False))
            elif part == "D":
                self._pieces(out, frame_no, at, header_len, payload_len, piece)
                if at + len(piece) == header_len + payload_len:
                    out.append(self._end(frame_no, payload_len, None, False))
        return out

    def _pieces(self, out: list[tuple], frame_no: int, at: int, header_len: int, payload_len: int, piece: bytes) -> None:
        """Bytes from place ``at`` of header and payload on, cut where parts begin."""
        used = 0
        while used < len(piece):
            if at < header_len:
                part_no, until = HEADER_PART, header_len
            else:
                part_no = (at - header_len) // self.part_bytes
                until = min(header_len + (part_no + 1) * self.part_bytes, header_len + payload_len)
            own = piece[used : used + until - at]
            at, used = at + len(own), used + len(own)
            self._fresh.append(own)
            if at == until:
                out.append(self._part(frame_no, part_no, self._open_bytes()))

    def _close(self, cutter: FrameCutter, repeated: int, lost: int) -> Iterator[tuple]:
        """What a closing connection leaves open: its first frame always, a later one once payload has come."""
        frame_no, header_len, payload_len, left, _, phase = cutter.state()
        content = self._open_bytes()
        if phase == "body":
            size = max(payload_len - left, 0)
            if size % self.part_bytes:
                yield self._part(frame_no, size // self.part_bytes, content)
            if size or not frame_no:
                yield self._end(frame_no, size, None, True)
        elif phase != "dead" and not frame_no:
            yield self._end(0, 0, None, True)
        if repeated or lost:
            yield self._loss(repeated, lost)

    # --- rows

    def _part(self, frame_no: int, part_no: int, content: bytes) -> tuple:
        return (frame_no, part_no, content, len(content), None, None, None, None)

    def _end(self, frame_no: int, size: int, reason: str | None, truncated: bool) -> tuple:
        return (frame_no, END_PART, None, size, reason, truncated, None, None)

    def _loss(self, repeated: int, lost: int) -> tuple:
        return (-1, LOSS_PART, None, None, None, None, repeated, lost)

    def _frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=self.COLUMNS)
        for name in ("size", "repeated", "lost"):
            out[name] = out[name].astype("Int64")
        out["truncated"] = out["truncated"].astype("boolean")
        out.insert(0, self.conn, [key[0]] * len(rows))
        return out


def stream_frame_parts(
    segments: DataFrame,
    conn: str = "conn_id",
    seq: str = "seq",
    at: str = "ts",
    closes: str | None = None,
    profile: str = "v2",
    idle_ms: int = 600_000,
    watermark: str = "10 minutes",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """O35. The flows of a stream of segments, in parts: ``conn, frame_no, part_no, content, size, reason, truncated, ..``.

    Part -1 is a flow's header, parts from 0 on are stretches of ``part_bytes`` of its payload, and part -2 says that the
    flow has ended: its ``size``, whether it is ``truncated`` (the connection closed inside it) and a ``reason`` if its
    lengths were bad. Part -3 counts what a connection lost: ``repeated`` segments, and segments ``lost`` behind a gap.

    Segments of a connection are numbered 0, 1, 2 ... and may come out of order. A connection closes with the segment whose
    ``closes`` column is true, or ``idle_ms`` after its latest segment by the watermark; its number may then be used anew.
    :func:`flows_of_parts` and :func:`flow_parts` read what was written.
    """
    conn_type = segments.schema[conn].dataType.simpleString()
    wanted = (
        segments.withColumn("ms", epoch_millis(segments, at))
        .withColumn("closes", F.coalesce(F.col(closes), F.lit(False)) if closes else F.lit(False))
        .withWatermark(at, watermark)
        .select(conn, F.col(seq).cast("bigint").alias("seq"), "bytes", "closes", "ms", at)
    )
    return wanted.groupBy(conn).transformWithStateInPandas(
        statefulProcessor=FlowCutter(conn, frame_prefix_bytes(profile), idle_ms, part_bytes),
        outputStructType=f"`{conn}` {conn_type}, {_PARTS}",
        outputMode="Append",
        timeMode="EventTime",
    )


def flow_parts(parts: DataFrame, conn: str = "conn_id", on_truncated: str = SUCCESS) -> DataFrame:
    """Payload parts of ended flows from a table of :func:`stream_frame_parts`, each with its flow's outcome.

    ``attributes`` are on part 0. A flow without payload, or in error, is one row with part 0 and no content. Payloads are
    joined by part: what is joined by flow is its header and its end.
    """
    key = [conn, "frame_no"]
    ends = parts.filter(F.col("part_no") == END_PART).select(*key, "size", "reason", "truncated")
    heads = parts.filter(F.col("part_no") == HEADER_PART).select(
        *key, headers.header_attributes(F.decode("content", "UTF-8")).alias("decoded"), F.lit(True).alias("has_header")
    )
    flows = ends.join(heads, key, "left")
    has_header = F.coalesce("has_header", F.lit(False)) & ~F.col("truncated")
    reason = F.coalesce("reason", F.when(has_header & F.col("decoded").isNull(), "bad_header"))
    if on_truncated == ERROR:
        reason = F.coalesce(reason, F.when(F.col("truncated"), "truncated"))
    flows = flows.withColumn("reason", reason)
    good = F.col("reason").isNull()
    flows = flows.withColumn("decoded", F.when(good & has_header, F.col("decoded")))
    each = F.col("part_no") == 0  # one row of a flow in error
    bodies = parts.filter(F.col("part_no") >= 0).select(*key, "part_no", "content")
    numbers = bodies.select(*key, "part_no")
    wanted = flows.join(numbers, key, "left").withColumn("part_no", F.coalesce("part_no", F.lit(0)))
    return (
        wanted.filter(good | each)
        .join(bodies, [*key, "part_no"], "left")
        .select(
            *key,
            "part_no",
            F.when(good, F.coalesce("content", F.unhex(F.lit("")))).alias("content"),
            F.when(each, F.col("decoded")).alias("attributes"),
            F.when(good, F.col("size")).alias("size"),
            F.when(good, SUCCESS).otherwise(ERROR).alias("outcome"),
            "reason",
            "truncated",
        )
    )


def flows_of_parts(parts: DataFrame, conn: str = "conn_id", on_truncated: str = SUCCESS) -> DataFrame:
    """Whole flows, one row each as in ``segments_to_flows``, for flows that fit a cell."""
    rows = flow_parts(parts, conn, on_truncated)
    return (
        rows.groupBy(conn, "frame_no")
        .agg(
            F.first("attributes", ignorenulls=True).alias("attributes"),
            F.expr("listagg(content) within group (order by part_no)").alias("content"),
            *(F.first(c).alias(c) for c in ("size", "outcome", "reason", "truncated")),
        )
    )


def segment_losses(parts: DataFrame, conn: str = "conn_id") -> DataFrame:
    """Per connection that lost any: ``repeated`` segments, and segments ``lost`` behind a gap that never closed."""
    losses = parts.filter(F.col("part_no") == LOSS_PART)
    return losses.groupBy(conn).agg(F.sum("repeated").alias("repeated"), F.sum("lost").alias("lost"))
