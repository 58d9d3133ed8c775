"""Continuous reassembly of datagrams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from flowtables.functions import headers
from flowtables.functions.times import epoch_millis
from flowtables.operators.timeouts import FLUSH_PIECES, TIMEOUT
from flowtables.schema import ERROR, FLOW_KEY, MAX_BLOB_BYTES, SUCCESS, datagram_profile
from flowtables.streaming.together import BUCKETS, Together, bucket_of

_META = (
    "n long, payload_length long, header string, said_ms long, said_seq long, count long, "
    "at long, usable long, left long, deadline long, closed boolean, held long"
)
_PIECE = "first_ms long, last_ms long, last_seq long, payload binary"
_LONG_AGO = -(1 << 62)


def _merged(one: tuple | None, other: tuple) -> tuple:
    """The first arrival of a piece starts its use, the last one's payload wins."""
    if one is None:
        return other
    newer = max(one, other, key=lambda p: p[1:3])
    return min(one[0], other[0]), *newer[1:]


class FlowAssembler(StatefulProcessor):
    """Keeps the pieces of one flow until all are there, the flow stalls or it proves too large.

    Verdicts follow from the arrival times kept with the pieces, not from the order in which rows are handed over: a
    flow is complete as soon as all of it came in time, and late only when the watermark has passed its deadline.
    """

    def __init__(self, key: Sequence[str], timeout_ms: int, keep_ms: int, max_bytes: int, flush_pieces: int, extra: int):
        self.result = Row(*key, "payload_length", "header", "content", "verdict")
        self.timeout_ms, self.keep_ms = timeout_ms, keep_ms
        self.max_bytes, self.flush_pieces, self.extra = max_bytes, flush_pieces, extra

    def init(self, handle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", _META)
        self.pieces = handle.getMapState("pieces", "counter long", _PIECE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load()
        if self.closed:
            return  # late pieces of a finished flow
        fresh: dict[int, tuple] = {}
        n_before, added, latest = self.n, [], 0
        for row in rows:
            latest = max(latest, row.arrival_ms)
            if row.header_type == 0:
                self._announce(row)
            counter = int(row.counter)
            if self.held > self.max_bytes:
                continue  # too much for a cell already
            known = fresh.get(counter)
            if known is None:
                known = self._stored_piece(counter)
                if known is None:
                    added.append(counter)
                    self.held += len(row.payload)
            fresh[counter] = _merged(known, (row.arrival_ms, row.arrival_ms, row.arrival_seq, bytes(row.payload)))
        if self.n is not None and self.n != n_before:
            added = self._counters() | set(added)
            self.count = 0
        if self.n is not None:
            self.count += sum(c < self.n for c in added)
            if max(self.held, self.payload_length) > self.max_bytes:
                yield self._result(key, "oversize", {})
                self._close(latest)
                return
            if 0 < self.n == self.count:
                whole = self._whole(fresh)
                if self._walk(whole.get)[0] == self.n:
                    yield self._result(key, SUCCESS, whole)
                    self._close(latest)
                    return
        for counter, piece in fresh.items():
            self.pieces.updateValue((counter,), piece)
        if self.at == 0 and 0 in fresh:
            self.deadline = fresh[0][0] + self.timeout_ms
        self._save()
        # Pieces that are never announced are forgotten after the same time.
        self._set_timer(latest + self.timeout_ms if self.n is None else self.deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        if self.closed or self.n is None:  # a finished flow nobody sends to any more, or an orphan
            if not self.closed:
                self.pieces.clear()
            self.meta.clear()
            return
        now = timerValues.getCurrentWatermarkInMs()  # nothing earlier comes any more
        self.at, self.usable, self.left, self.deadline = self._walk(self._stored_piece, now)
        if self.deadline > now:  # flushed meanwhile
            self._save()
            self._set_timer(self.deadline)
            return
        yield self._result(key, TIMEOUT, {})
        self._close(now)

    def close(self) -> None:
        pass

    def _announce(self, row) -> None:
        """The latest announcement holds, as in ``announcements``."""
        said = (row.arrival_ms, row.arrival_seq)
        if self.n is None or said >= (self.said_ms, self.said_seq):
            self.n, self.payload_length, self.header = int(row.n_datagrams) + self.extra, int(row.payload_length), row.header
            self.said_ms, self.said_seq = said

    def _walk(self, piece_at: Callable[[int], tuple | None], until: int | None = None) -> tuple[int, int, int, int]:
        """How far the pieces were written in time, going on from where the flow was settled.

        Gives the next piece, the time at which those before it were all there, the first piece not flushed and the
        deadline. Arrivals after ``until`` are not looked at, as others may still come before them.
        """
        at, usable, left, deadline = self.at, self.usable, self.left, self.deadline
        while at < self.n:
            piece = piece_at(at)
            moment = None if piece is None else max(usable, piece[0])
            if at == 0 and moment is not None:
                deadline = moment + self.timeout_ms
            if (moment is None or moment > usable) and at - left >= self.flush_pieces:
                left, deadline = at, usable + self.timeout_ms
            if moment is None or moment > deadline or (until is not None and moment > until):
                break
            at, usable = at + 1, moment
        return at, usable, left, deadline

    def _stored_piece(self, counter: int) -> tuple | None:
        if not self.stored or not self.pieces.containsKey((counter,)):
            return None
        return tuple(self.pieces.getValue((counter,)))

    def _counters(self) -> set[int]:
        return {c for (c,) in self.pieces.keys()} if self.stored else set()

    def _whole(self, fresh: dict[int, tuple]) -> dict[int, tuple]:
        return ({c: tuple(p) for (c,), p in self.pieces.iterator()} if self.stored else {}) | fresh

    def _result(self, key, verdict: str, whole: dict[int, tuple]) -> Row:
        content = b"".join(bytes(whole[c][3]) for c in range(self.n)) if verdict == SUCCESS else None
        return self.result(*key, self.payload_length, self.header, content, verdict)

    def _close(self, at: int) -> None:
        if self.stored:
            self.pieces.clear()
        self.closed, self.deadline = True, at
        self._save()
        self._set_timer(at + self.keep_ms)

    def _load(self) -> None:
        self.stored = self.meta.exists()
        known = self.meta.get() if self.stored else (None, None, None, None, None, 0, 0, _LONG_AGO, 0, None, False, 0)
        (self.n, self.payload_length, self.header, self.said_ms, self.said_seq, self.count, self.at, self.usable,
         self.left, self.deadline, self.closed, self.held) = known

    def _save(self) -> None:
        self.meta.update(
            (self.n, self.payload_length, self.header, self.said_ms, self.said_seq, self.count, self.at, self.usable,
             self.left, self.deadline, self.closed, self.held)
        )

    def _set_timer(self, at: int) -> None:
        if self.stored:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(at))


def stream_reassemble(
    datagrams: DataFrame,
    timeout_ms: int = 2000,
    watermark: str = "10 minutes",
    key: Sequence[str] = FLOW_KEY,
    at: str = "arrival_ts",
    profile: str = "v0",
    keep_ms: int = 600_000,
    max_blob_bytes: int = MAX_BLOB_BYTES,
    flush_pieces: int = FLUSH_PIECES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """O34. Flows as soon as their last piece is there, on a stream of datagrams.

    The rows are those of ``reassemble``. A flow whose writing stalls for longer than ``timeout_ms`` is an error
    (``timeout``), one of more than ``max_blob_bytes``, announced or arrived, another (``oversize``, no more is buffered for
    it; :func:`stream_reassemble_parts` has no such limit). The verdict depends on the times of arrival only, not on the
    order of rows. State is on disk, in buckets of flows (see ``together``); a finished flow is remembered for ``keep_ms`` so that late pieces
    are dropped, pieces without announcement are forgotten after ``timeout_ms``.
    """
    columns = set(datagrams.columns)
    order = F.col("arrival_seq") if "arrival_seq" in columns else F.lit(0).cast("bigint")
    never = F.col(at) < F.lit("0001-01-01").cast("timestamp")
    wanted = (
        datagrams.withColumn("arrival_ms", epoch_millis(datagrams, at))
        .withColumn("arrival_seq", order)
        .withWatermark(at, watermark)
        .select(*key, "header_type", "counter", "n_datagrams", "payload_length", "header", "payload", "arrival_ms", "arrival_seq", at)
        # The condition names the time column, so it is not pushed below the watermark, which keepalives thus still move.
        .filter(
            ((F.col("header_type") == 0) & (F.col("counter") == 0))
            | ((F.col("header_type") == 1) & (F.col("counter") > 0))
            | never
        )
    )
    key_schema = ", ".join(f"`{c}` {datagrams.schema[c].dataType.simpleString()}" for c in key)
    extra = 0 if datagram_profile(profile).announces_first else 1
    processor = FlowAssembler(key, timeout_ms, keep_ms, max_blob_bytes, flush_pieces, extra)
    done = wanted.withColumn("_bucket", bucket_of(key, buckets)).groupBy("_bucket").transformWithState(
        statefulProcessor=Together(processor, key),
        outputStructType=f"{key_schema}, payload_length long, header string, content binary, verdict string",
        outputMode="Append",
        timeMode="EventTime",
    )
    attributes = headers.header_attributes(F.col("header"))
    done = done.withColumn("attributes", attributes)
    bad_header = (F.octet_length("header") > 0) & F.col("attributes").isNull()
    reason = F.when(F.col("verdict") != SUCCESS, F.col("verdict")).when(bad_header, "bad_header")
    good = F.col("reason").isNull()
    size = F.octet_length("content").cast("bigint")
    return done.withColumn("reason", reason).select(
        *key,
        F.when(good, F.col("attributes")).alias("attributes"),
        F.when(good, F.col("content")).alias("content"),
        F.when(good, size).alias("size"),
        F.when(good, SUCCESS).otherwise(ERROR).alias("outcome"),
        "reason",
        F.when(good, size == F.col("payload_length")).alias("length_ok"),
    )
