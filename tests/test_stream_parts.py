"""Chained stateful operators: flows of any size out of streams, with closes, timeouts and losses."""

import random
import struct
from datetime import timedelta

import pytest

from flowtables.operators import datagrams as dg
from flowtables.operators import framed
from flowtables.operators.timeouts import classify_timeouts
from flowtables.streaming.framed import flow_parts, flows_of_parts, segment_losses, stream_frame_parts
from flowtables.streaming.parts import datagram_losses, reassembled_parts, stream_reassemble_parts
from test_datagrams import piece
from test_framed import STREAM, frame, segments
from test_streaming import START, keepalive, run, timed  # noqa: F401

SEGMENT = "conn_id long, seq long, bytes binary, closes boolean, ts timestamp"


def cut(conn, data, size, closes=True, at=0, first=0):
    pieces = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
    return [(conn, first + i, p, closes and i == len(pieces) - 1, START + timedelta(seconds=at + i)) for i, p in enumerate(pieces)]


FRAME_PARTS = (
    "conn_id long, frame_no long, part_no long, content binary, size long, reason string, truncated boolean, "
    "repeated long, lost long"
)


@pytest.fixture
def frames(spark, run):  # noqa: F811
    def go(batches, watermark="10 seconds", **options):
        late = [(-1, 0, b"", False, START + timedelta(days=30))]
        tables = [spark.createDataFrame(b, SEGMENT) for b in [*batches, late]]
        transform = lambda s: stream_frame_parts(s, closes="closes", watermark=watermark, idle_ms=60_000, **options)
        out = run(tables, transform)
        return spark.createDataFrame([tuple(r) for r in out], FRAME_PARTS)

    return go


@pytest.mark.parametrize("n_batches", [1, 8])
def test_flows_of_a_stream_are_those_of_the_table(spark, frames, n_batches):
    truncated = frame() + frame(payload=b"p" * 50)[:-9]
    streams = {
        1: STREAM, 2: truncated, 3: frame(payload=b"r" * 200), 4: b"", 5: frame()[:5], 6: frame(b'{"x"', b"bad header") + frame(),
        7: frame() + struct.pack(">iq", 3, -1) + b"never read", 8: frame() + frame()[:14], 9: frame(b'{"a":"bcdef"}', b"")[:-3],
    }
    rows = [r for conn, data in streams.items() for r in cut(conn, data, 9, closes=conn % 2 == 0, at=conn)]
    random.Random(n_batches).shuffle(rows)
    size = -(-len(rows) // n_batches)
    parts = frames([rows[i : i + size] for i in range(0, len(rows), size)], "1 hour", part_bytes=16)
    columns = ("conn_id", "frame_no", "attributes", "content", "size", "outcome", "reason", "truncated")
    got = sorted((tuple(r[c] for c in columns) for r in flows_of_parts(parts).collect()), key=repr)
    expected = framed.segments_to_flows(segments(spark, streams, 9)).collect()
    assert got == sorted((tuple(r[c] for c in columns) for r in expected), key=repr)
    strict = {(r["conn_id"], r["frame_no"]): r["reason"] for r in flows_of_parts(parts, on_truncated="error").collect()}
    assert strict[2, 1] == "truncated" and strict[1, 0] is None
    # No part is longer than asked for, and each is given once.
    assert all(len(r["content"] or b"") <= 16 for r in flow_parts(parts).collect())
    keys = [(r["conn_id"], r["frame_no"], r["part_no"]) for r in parts.filter("part_no > -3").collect()]
    assert len(keys) == len(set(keys))
    assert segment_losses(parts).count() == 0


def test_an_idle_connection_is_forgotten_and_its_number_used_anew(spark, frames):
    first = cut(1, frame(payload=b"one") + frame(payload=b"cut off")[:-3], 7, closes=False)
    # Segment 1 is lost, others come twice, and one more after the connection was closed.
    gap = [r for r in cut(2, frame(payload=b"x" * 30), 10) if r[1] != 1]
    closed = cut(3, frame(payload=b"three"), 50)
    again = cut(1, frame(payload=b"two"), 7, at=500)
    parts = frames([first + gap + closed + gap[:1], closed + [(8, 0, b"", False, START + timedelta(seconds=400))], again])
    rows = [(r["conn_id"], r["frame_no"], r["content"], r["truncated"]) for r in parts.filter("part_no >= -2").collect() if r["part_no"] != -1]
    contents = {(c, n, b) for c, n, b, _ in rows if b is not None}
    assert contents == {(1, 0, b"one"), (1, 1, b"cut "), (3, 0, b"three"), (1, 0, b"two")}
    ends = sorted((c, n, t) for c, n, b, t in rows if b is None)
    assert ends == [(1, 0, False), (1, 0, False), (1, 1, True), (2, 0, True), (3, 0, False), (8, 0, True)]
    losses = {r["conn_id"]: (r["repeated"], r["lost"]) for r in segment_losses(parts).collect()}
    assert losses == {2: (1, len(gap) - 1), 3: (1, 0)}


PARTS = (
    "source string, flow_id long, part_no long, counters array<long>, lengths array<long>, content binary, n long, "
    "payload_length long, header string, size long, verdict string, repeated long, late long, orphaned long, unknown long"
)


@pytest.mark.parametrize("n_batches", [1, 8])
def test_parts_of_a_stream_are_those_of_the_table(spark, run, n_batches):  # noqa: F811
    rng = random.Random(n_batches)
    pieces = []
    for flow in range(40):
        n, step = rng.choice([1, 2, 5, 6, 12, 30]), rng.choice([5, 30, 80])
        for c in range(n):
            if rng.random() > 0.02:
                at = c * step + rng.randint(0, 20)
                body = bytes(rng.randrange(256) for _ in range(rng.randrange(4)))
                pieces += [piece(flow, c, n, at=at, header=f'{{"f":"{flow}"}}', payload=body)] * rng.choice([1, 1, 2])
        if flow % 9 == 0:
            pieces.append(piece(flow, n + 7, at=3))  # a stray
    df = timed(spark, pieces)
    if n_batches == 1:
        rng.shuffle(pieces)
    else:
        pieces.sort(key=lambda p: p[8])
    size = -(-len(pieces) // n_batches)
    batches = [timed(spark, pieces[i : i + size]) for i in range(0, len(pieces), size)] + [keepalive(spark)]
    rows = run(batches, lambda s: stream_reassemble_parts(s, 200, "1 hour", flush_pieces=5, part_pieces=4))
    rows = spark.createDataFrame([tuple(r) for r in rows], PARTS)
    judged = {r["flow_id"]: r["outcome"] for r in classify_timeouts(df, 200, at="arrival_ms", flush_pieces=5).collect()}
    columns = ("flow_id", "part_no", "content", "attributes", "size", "outcome", "length_ok")
    whole = {tuple(r[c] for c in columns[:2]): r for r in dg.reassemble_parts(df, part_pieces=4).collect()}
    got = reassembled_parts(rows).collect()
    assert len(got) == len({(r["flow_id"], r["part_no"]) for r in got})
    assert {r["flow_id"] for r in got} == set(judged)
    for r in got:
        if judged[r["flow_id"]] == "success":
            expected = whole.pop((r["flow_id"], r["part_no"]))
            assert [r[c] for c in columns] == [expected[c] for c in columns]
        else:
            assert (r["part_no"], r["content"], r["outcome"], r["reason"]) == (0, None, "error", "timeout")
    assert not [k for k in whole if judged.get(k[0]) == "success"]
    counted = {}
    for p in pieces:
        counted.setdefault(p[1], []).append(p[3])
    losses = {r["flow_id"]: r for r in datagram_losses(rows).collect()}
    for flow, counters in counted.items():
        lost = losses.get(flow)
        assert (lost["repeated"] if lost else 0) == len(counters) - len(set(counters))
        assert (lost["orphaned"] if lost else 0) == (0 if 0 in counters else len(set(counters)))


def test_what_is_lost_is_counted(spark, run):  # noqa: F811
    batches = [
        [piece(1, 0, 3, at=0), piece(1, 1, at=1), piece(2, 0, 2, at=5), piece(2, 1, at=6), piece(3, 4, at=7), piece(4, 1, kind=0, n=2, at=8), piece(5, 0, kind=1, at=9)],
        [piece(9, 0, 1, at=100_000)],
        # Flow 1 has timed out, flow 2 is complete, flow 3 was never announced.
        [piece(1, 2, at=110_000), piece(2, 1, at=110_000), piece(2, 5, at=110_000), piece(9, 0, 1, at=110_001)],
    ]
    rows = run([timed(spark, b) for b in batches] + [keepalive(spark)], lambda s: stream_reassemble_parts(s, 2000, "1 second", part_pieces=4))
    rows = spark.createDataFrame([tuple(r) for r in rows], PARTS)
    got = {r["flow_id"]: (r["repeated"], r["late"], r["orphaned"], r["unknown"]) for r in datagram_losses(rows).collect()}
    assert got == {1: (0, 1, 0, 0), 2: (1, 1, 0, 0), 3: (0, 0, 1, 0), 4: (0, 0, 0, 1), 5: (0, 0, 0, 1), 9: (1, 0, 0, 0)}
    flows = {r["flow_id"]: (r["outcome"], r["reason"], r["content"]) for r in reassembled_parts(rows).collect()}
    assert flows == {1: ("error", "timeout", None), 2: ("success", None, b"AB"), 9: ("success", None, b"A")}


def test_a_flow_above_any_count_of_pieces_comes_in_parts(spark, run):  # noqa: F811
    n = 9000
    pieces = [piece(1, c, n, at=c // 10, payload=struct.pack(">i", c)) for c in range(n)]
    batches = [timed(spark, pieces[i : i + 1200]) for i in range(0, n, 1200)] + [keepalive(spark)]
    rows = run(batches, lambda s: stream_reassemble_parts(s, 2000, "1 minute", part_pieces=1000))
    parts = reassembled_parts(spark.createDataFrame([tuple(r) for r in rows], PARTS)).orderBy("part_no").collect()
    assert [r["part_no"] for r in parts] == list(range(9)) and {r["size"] for r in parts} == {4 * n}
    assert b"".join(r["content"] for r in parts) == b"".join(struct.pack(">i", c) for c in range(n))
    assert parts[0]["attributes"] == {} and all(r["attributes"] is None for r in parts[1:])


class CountedState:
    """State of one key that counts how often it is asked."""

    def __init__(self):
        self.calls, self.states, self.timers = 0, {}, set()

    def getValueState(self, name, *schema):
        return CountedValues(self, name)

    getListState = getMapState = getValueState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def listTimers(self):
        return iter(sorted(self.timers))


class CountedValues:
    def __init__(self, owner, name):
        self.owner, self.name = owner, name

    def _kept(self):
        self.owner.calls += 1
        return self.owner.states.setdefault(self.name, {})

    def exists(self):
        return bool(self._kept())

    def get(self):
        kept = self._kept()
        return kept.get("value") if self.name != "open" else iter(list(kept.values()))

    def update(self, value):
        self._kept()["value"] = value

    def clear(self):
        self._kept().clear()

    def appendValue(self, value):
        kept = self._kept()
        kept[len(kept)] = value

    def containsKey(self, key):
        return key in self._kept()

    def getValue(self, key):
        return self._kept()[key]

    def updateValue(self, key, value):
        self._kept()[key] = value

    def removeKey(self, key):
        del self._kept()[key]

    def keys(self):
        return iter(list(self._kept()))


def fed(cutter, batches):
    """What a cutter gives for batches of (seq, bytes, closes): rows of all batches."""
    import pandas as pd

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    rows = []
    for batch in batches:
        table = pd.DataFrame([(*r, 5) for r in batch], columns=["seq", "bytes", "closes", "ms"])
        for out in cutter.handleInputRows((1,), iter([table]), Times()):
            rows += list(out.itertuples(index=False))
    return rows


def test_state_is_asked_by_batch_and_run_not_by_segment():
    from flowtables.streaming.framed import FlowCutter

    data = b"".join(frame(payload=bytes([i % 256]) * 90) for i in range(400))
    every = [(seq, p, closes) for _, seq, p, closes, _ in cut(1, data, 10)]
    state, cutter = CountedState(), FlowCutter("conn_id", 12, 60_000, 50)
    cutter.init(state)
    # The first segment comes last: all others are early, in four runs.
    n = len(every) // 4
    rows = fed(cutter, [every[3 * n :], every[n : 2 * n], every[2 * n : 3 * n] + every[n : n + 5], every[:n]])
    assert state.calls < 60
    payload = {(r.frame_no, r.part_no): r.content for r in rows if r.part_no >= 0}
    assert payload == {(i, k): bytes([i % 256]) * (50, 40)[k] for i in range(400) for k in (0, 1)}
    assert [(r.repeated, r.lost) for r in rows if r.part_no == -3] == [(5, 0)]
    assert not state.states["early"] and not state.states["open"]


def test_a_connection_closes_once_whatever_comes_after():
    from flowtables.streaming.framed import FlowCutter

    every = [(seq, p, closes) for _, seq, p, closes, _ in cut(1, frame(payload=b"x" * 30)[:-5], 10)]
    cutter = FlowCutter("conn_id", 12, 60_000, 8)
    cutter.init(CountedState())
    rows = fed(cutter, [every[:2], every[2:], every[-1:], every[:1]])
    assert [(r.size, r.truncated) for r in rows if r.part_no == -2] == [(25, True)]
    assert [r.repeated for r in rows if r.part_no == -3] == [1, 1]
    assert [r.content for r in rows if r.part_no >= 0] == [b"x" * 8] * 3 + [b"x"]
    # Closed inside a run of early segments, with a run right behind it: all behind the close is lost.
    cutter = FlowCutter("conn_id", 12, 60_000, 8)
    cutter.init(CountedState())
    some = [(i, b"", i == 2) for i in range(9)]
    rows = fed(cutter, [some[1:3], some[3:6], some[6:7], some[:1]])
    assert [(r.repeated, r.lost) for r in rows if r.part_no == -3] == [(0, 4)]


def test_state_is_asked_by_bucket_not_by_flow():
    from pyspark.sql import Row

    from flowtables.streaming.reassembly import FlowAssembler
    from flowtables.streaming.together import Together

    class Times:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

    def arrived(flow, counter, at):
        return Row(
            source="s", flow_id=flow, header_type=min(counter, 1), counter=counter, n_datagrams=1, payload_length=2, header="{}",
            payload=bytes([65 + counter]), arrival_ms=at, arrival_seq=0,
        )

    state, key = CountedState(), ["source", "flow_id"]
    both = Together(FlowAssembler(key, 100, 1000, 1 << 20, 1001, 1), key)
    both.init(state)
    # 500 flows come whole; of one the second piece comes a batch later, of another never.
    whole = [arrived(f, c, 10 + c) for f in range(500) for c in (0, 1)]
    out = list(both.handleInputRows((3,), iter([*whole, arrived(500, 0, 10), arrived(501, 0, 10)]), Times(0)))
    assert state.calls < 20 and sorted(r.flow_id for r in out) == list(range(500))
    out = list(both.handleInputRows((3,), iter([arrived(500, 1, 60), arrived(7, 1, 61)]), Times(20)))
    assert [(r.flow_id, r.verdict, r.content) for r in out] == [(500, "success", b"AB")]
    assert state.timers == {110}
    out = list(both.handleExpiredTimer((3,), Times(200), None))
    assert [(r.flow_id, r.verdict) for r in out] == [(501, "timeout")]
    assert state.calls < 60 and not state.states["cells"]
    # Finished flows are forgotten in time, and then nothing is left.
    assert list(both.handleExpiredTimer((3,), Times(5000), None)) == []
    assert not state.states["index"]
