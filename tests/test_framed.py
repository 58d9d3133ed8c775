import random
import struct

import pytest
from pyspark.sql import functions as F

from flowtables.operators import framed
from flowtables.operators.framecutter import FrameCutter
from flowtables.operators.hot_connections import frame_chains

SEGMENTS = "conn_id long, seq long, bytes binary"


def frame(header=b'{"a":"b"}', payload=b"xyz", profile="v2"):
    version = {"v2": b"", "v0": b"\0\0\0\0", "legacy": b"\0\0\0\1"}[profile]
    return version + struct.pack(">iq", len(header), len(payload)) + header + payload


def segments(spark, streams, size):
    rows = []
    for conn, data in streams.items():
        cuts = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
        rows += [(conn, seq, part) for seq, part in enumerate(cuts)]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, SEGMENTS)


def decode(spark, streams, size=10, **options):
    rows = framed.segments_to_flows(segments(spark, streams, size), **options).collect()
    return {(r["conn_id"], r["frame_no"]): r for r in rows}


def plain(rows):
    return {k: (r["attributes"], r["content"], r["size"], r["outcome"], r["reason"], r["truncated"]) for k, r in rows.items()}


STREAM = frame() + frame(b"", b"") + frame(b"", b"only payload") + frame(b"{}", b"") + frame(payload=b"q" * 70)
PARSED = [
    ({"a": "b"}, b"xyz"), (None, b""), (None, b"only payload"), ({}, b""), ({"a": "b"}, b"q" * 70),
]

BOTH_WAYS = pytest.mark.parametrize(
    "way", [{}, {"hot_bytes": 0, "block_bytes": 32}, {"hot_bytes": 0}]
)


@BOTH_WAYS
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_frames_across_segments(spark, way, size):
    rows = decode(spark, {1: STREAM, 2: frame()}, size, **way)
    assert [(rows[1, i]["attributes"], rows[1, i]["content"]) for i in range(5)] == PARSED
    assert len(rows) == 6 and all(r["outcome"] == "success" and not r["truncated"] for r in rows.values())


@pytest.mark.parametrize("profile", ["v0", "legacy"])
@BOTH_WAYS
def test_versioned_frames(spark, profile, way):
    stream = b"".join(frame(payload=b"n%d" % i, profile=profile) for i in range(9))
    rows = decode(spark, {1: stream}, 11, profile=profile, **way)
    assert [rows[1, i]["content"] for i in range(9)] == [b"n%d" % i for i in range(9)]


def expected_when_closed_at(cut):
    """What a connection leaves that closes after ``cut`` bytes of STREAM."""
    out, at = {}, 0
    for i, (attributes, content) in enumerate(PARSED):
        header = {0: 9, 1: 0, 2: 0, 3: 2, 4: 9}[i]
        end = at + 12 + header + len(content)
        if cut >= end:
            out[i] = (attributes, content, False)
        else:
            got = max(cut - at - 12 - header, 0)
            if i == 0 or got:
                out[i] = (None, content[:got], True)
            break
        at = end
    return out


@BOTH_WAYS
def test_connection_closed_at_every_byte(spark, way):
    streams = {cut: STREAM[:cut] for cut in range(len(STREAM) + 1)}
    rows = decode(spark, streams, 16, **way)
    seen = {}
    for (conn, number), r in rows.items():
        seen.setdefault(conn, {})[number] = (r["attributes"], r["content"], r["truncated"])
    assert seen == {cut: expected_when_closed_at(cut) for cut in streams}


def test_truncated_flows_can_be_errors(spark):
    rows = decode(spark, {1: frame() + frame()[:-1]}, on_truncated="error")
    assert (rows[1, 0]["outcome"], rows[1, 1]["outcome"], rows[1, 1]["reason"]) == ("success", "error", "truncated")


@BOTH_WAYS
def test_bad_headers_do_not_stop_the_connection(spark, way):
    bad = [b"{", b"[1]", b"null", b"abc"]
    rows = decode(spark, {1: b"".join(frame(h) for h in bad) + frame()}, **way)
    assert [rows[1, i]["reason"] for i in range(5)] == ["bad_header"] * 4 + [None]
    assert rows[1, 4]["content"] == b"xyz"


@BOTH_WAYS
def test_negative_lengths_end_the_connection(spark, way):
    stream = frame() + struct.pack(">iq", -1, 5) + frame() * 3
    rows = decode(spark, {1: stream, 2: struct.pack(">iq", 3, -1) + b"abc" * 40, 3: frame() * 4}, **way)
    assert {k: r["reason"] for k, r in rows.items() if k[0] == 1} == {(1, 0): None, (1, 1): "bad_length"}
    assert rows[2, 0]["reason"] == "bad_length" and len([k for k in rows if k[0] == 3]) == 4


@BOTH_WAYS
def test_oversize_payload_is_reported_and_read_in_chunks(spark, way):
    stream = frame(payload=b"m" * 500) + frame() + frame(b'{"c":"' + b"d" * 200 + b'"}', b"e" * 300) + frame(b"", b"tail")
    rows = decode(spark, {1: stream}, 64, max_blob_bytes=400, **way)
    assert [rows[1, i]["reason"] for i in range(4)] == ["oversize", None, None, None]
    pieces = framed.segments_to_flows(segments(spark, {1: stream}, 64), output="chunks", **way).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: (p["frame_no"], p["offset"])):
        assert len(whole.get(p["frame_no"], b"")) == p["offset"] and p["outcome"] == "success"
        whole[p["frame_no"]] = whole.get(p["frame_no"], b"") + p["bytes"]
    assert whole == {0: b"m" * 500, 1: b"xyz", 2: b"e" * 300, 3: b"tail"}


def test_random_streams_read_both_ways_alike(spark):
    rng = random.Random(3)
    streams = {}
    for conn in range(30):
        frames = []
        for _ in range(rng.randint(0, 12)):
            payload = bytes(rng.choice([0, 0, 0, 1, 65]) for _ in range(rng.choice([0, 3, 40, 200])))
            frames.append(frame(rng.choice([b"", b"{}", b'{"k":"v"}', b"zz"]), payload))
        stream = b"".join(frames)
        streams[conn] = stream[: rng.randint(0, len(stream))] if rng.random() < 0.4 else stream
    in_turn = plain(decode(spark, streams, 50))
    for block in (33, 128, 4096):
        assert plain(decode(spark, streams, 50, hot_bytes=0, block_bytes=block)) == in_turn


def test_a_connection_is_read_in_turn_behind_a_join_that_turns_into_a_broadcast(spark):
    streams = {conn: b"".join(frame(payload=b"%d-%d " % (conn, i) * (i % 40)) for i in range(60)) for conn in range(12)}
    settings = {"spark.sql.autoBroadcastJoinThreshold": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        cut = segments(spark, streams, 50).repartition(8).groupBy("conn_id", "seq").agg(F.max("bytes").alias("bytes"))
        cut = cut.withColumn("offset", F.col("seq") * 50)
        # Merged by the sizes that Spark expects, broadcast by those it finds: the bytes are then read where they were written.
        totals = cut.groupBy("conn_id").agg(F.max("offset").alias("last"))
        joined = cut.join(totals, "conn_id").filter(F.col("offset") <= F.col("last")).drop("last")
        rows = framed.segments_to_flows(joined).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 720
    assert {(r["conn_id"], r["frame_no"]): r["content"] for r in rows} == {
        (conn, i): b"%d-%d " % (conn, i) * (i % 40) for conn in streams for i in range(60)
    }


def test_long_connections_are_resolved_by_blocks(spark):
    stream = b"".join(frame(payload=b"t%d" % i * (i % 50)) for i in range(400))
    df = segments(spark, {1: stream}, 100)
    blocks = framed.byte_blocks(df, "conn_id", "seq", 1000, after=11)
    pieces, unresolved = framed.cut_blocks(blocks, "conn_id", 12, 1000, None)
    assert unresolved.count() == 0
    assert pieces.filter("part = 'F' and header_len is not null").count() == 400


def test_frame_chains_leave_the_block():
    data = frame() + frame() + frame(payload=b"l" * 100)[:20]
    starts, exits, counts, lasts = frame_chains(data, 1000, 12)
    assert (starts[0], exits[0], counts[0], lasts[0]) == (1000, 1000 + 2 * 24 + 12 + 9 + 100, 3, 1048)


def test_cutter_resumes_from_its_state():
    whole = FrameCutter(12).feed(STREAM)
    for size in range(1, 20):
        pieces, state = [], None
        for i in range(0, len(STREAM), size):
            cutter = FrameCutter(12, state)
            pieces += cutter.feed(STREAM[i : i + size])
            state = cutter.state()
        assert len([p for p in pieces if p[1] == "F"]) == len([p for p in whole if p[1] == "F"])
        assert b"".join(p[5] or b"" for p in pieces) == b"".join(p[5] or b"" for p in whole)


@pytest.mark.parametrize("profile", ["v2", "v0", "legacy"])
@pytest.mark.parametrize("size", [1, 13, 10_000])
def test_lay_out_and_recover(spark, profile, size):
    rows = [(i, i % 3, {"n": "x%d" % i} if i % 4 else None, b"c" * (i * 7 % 40), i * 7 % 40) for i in range(30)]
    flows = spark.createDataFrame(
        rows, "flow_id long, conn_id long, attributes map<string,string>, content binary, size long"
    )
    cut = framed.flows_to_segments(flows, profile=profile, segment_bytes=size, order_block=4)
    got = framed.segments_to_flows(cut, profile=profile).collect()
    seen = sorted((r["conn_id"], r["frame_no"], r["attributes"], r["content"]) for r in got)
    assert seen == sorted((r[1], r[0] // 3, r[2], r[3]) for r in rows)


def test_content_only_mode(spark):
    flows = spark.createDataFrame(
        [(1, 9, {"a": "b"}, b"one", 3), (2, 9, None, b"two", 3)],
        "flow_id long, conn_id long, attributes map<string,string>, content binary, size long",
    )
    cut = framed.flows_to_segments(flows, mode="flow_only", segment_bytes=2)
    assert framed.raw_streams_to_flows(cut).first()["content"] == b"onetwo"


def test_raw_streams(spark):
    df = segments(spark, {1: b"hello world", 2: b"", 3: b"z" * 50}, 4)
    rows = {r["conn_id"]: r for r in framed.raw_streams_to_flows(df, max_blob_bytes=20).collect()}
    assert (rows[1]["content"], rows[2]["content"], rows[2]["size"]) == (b"hello world", b"", 0)
    assert (rows[3]["outcome"], rows[3]["reason"], rows[3]["size"], rows[3]["content"]) == ("error", "oversize", 50, None)
    parts = framed.raw_streams_to_flows(df, output="parts", part_bytes=30).orderBy("conn_id", "part_no").collect()
    assert [(r["conn_id"], r["part_no"], r["offset"], len(r["content"])) for r in parts] == [
        (1, 0, 0, 11), (3, 0, 0, 30), (3, 1, 30, 20),
    ]
    chunks = framed.raw_streams_to_flows(df, output="chunks").filter("conn_id = 3").orderBy("seq").collect()
    assert [r["offset"] for r in chunks] == list(range(0, 50, 4))


@pytest.mark.parametrize("delimiter", [b"\n", b"\r\n", b"{d}\r\n", b"aa", b"\\E.", b"\xff"])
@pytest.mark.parametrize("size,block", [(1, 5), (4, 8), (100, 1 << 20)])
def test_delimited_streams(spark, delimiter, size, block):
    rng = random.Random(len(delimiter) * size)
    streams = {}
    for conn in range(12):
        parts = [bytes(rng.choice(b"aab\xc3\xa9\r{") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 7))]
        streams[conn] = delimiter.join(parts) + rng.choice([b"", delimiter])
    got = framed.delimited_streams_to_flows(segments(spark, streams, size), delimiter, block_bytes=block).collect()
    expected = []
    for conn, data in streams.items():
        messages = data.split(delimiter)
        expected += [(conn, i, m) for i, m in enumerate(messages) if m or i < len(messages) - 1]
    assert sorted((r["conn_id"], r["msg_no"], r["content"]) for r in got) == sorted(expected)


@pytest.mark.parametrize("block", [3, 4, 7])
def test_overlapping_delimiters_over_many_blocks(spark, block):
    streams = {0: b"a" * 101, 1: b"aab" * 30, 2: b"aba" * 20 + b"aaaa", 3: b"baaaab" * 9, 4: b""}
    for delimiter in (b"aa", b"aba", b"aaa"):
        got = framed.delimited_streams_to_flows(segments(spark, streams, 5), delimiter, block_bytes=block).collect()
        expected = []
        for conn, data in streams.items():
            messages = data.split(delimiter)
            expected += [(conn, i, m) for i, m in enumerate(messages) if m or i < len(messages) - 1]
        assert sorted((r["conn_id"], r["msg_no"], r["content"]) for r in got) == sorted(expected)


def test_arguments_are_checked(spark):
    df = segments(spark, {1: frame()}, 5)
    with pytest.raises(ValueError):
        framed.segments_to_flows(df, profile="v9")
    with pytest.raises(ValueError):
        framed.segments_to_flows(df, output="rows")
    with pytest.raises(ValueError):
        framed.delimited_streams_to_flows(df, b"")


def test_flows_with_hashed_numbers_are_laid_end_to_end(spark):
    rng = random.Random(5)
    rows = [(i % 3, rng.randrange(2**62), {"n": str(i)}, bytes([65 + i % 26]) * rng.randrange(40)) for i in range(60)]
    flows = spark.createDataFrame(rows, "conn_id long, flow_id long, attributes map<string,string>, content binary")
    flows = flows.withColumn("size", F.octet_length("content").cast("bigint"))
    plain = framed.flows_to_segments(flows, segment_bytes=50, order_block=1 << 40)
    measured = framed.flows_to_segments(flows, segment_bytes=50, order_block=None)
    as_set = lambda df: sorted(tuple(r) for r in df.collect())
    assert as_set(measured) == as_set(plain)


def test_taking_blocks_apart_needs_memory_for_few_of_them():
    import subprocess
    import sys

    # In a process of its own, whose peak is its own: 200 blocks of 1 MB in one batch.
    code = """
import resource, struct
import pyarrow as pa
from flowtables.operators import framed, framecutter

class Table:  # keeps the function that tasks get
    schema = {"conn_id": type("F", (), {"dataType": type("D", (), {"simpleString": lambda self: "bigint"})()})()}
    def select(self, *a): return self
    repartition = sortWithinPartitions = select
    def mapInArrow(self, f, schema):
        Table.f = staticmethod(f)
        return self

framed._cut_in_turn(Table(), "conn_id", "seq", "v2")
one = struct.pack(">iq", 0, (1 << 20) - 12) + bytes((1 << 20) - 12)
batch = pa.record_batch([pa.array([1] * 200, pa.int64()), pa.array([one] * 200, pa.binary())], names=["conn_id", "bytes"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(out.num_rows for out in Table.f(iter([batch])))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=framed.__file__.split("/flowtables/")[0])
    n, grown = map(int, out.stdout.split())
    assert n == 401 and grown < 100


def test_many_short_connections_are_followed_without_a_call_each(spark):
    data = [b"", b"aa", b"aaa", b"baaab", b"aaaaaaaaa", b"xaaaay"]
    rows = [(conn, 0, data[conn % 6]) for conn in range(600)]
    df = spark.createDataFrame(rows, "conn_id long, seq long, bytes binary").repartition(3)
    split = framed.delimited_streams_to_flows(df, b"aa", block_bytes=2)
    got = sorted((r["conn_id"], r["msg_no"], r["content"]) for r in split.collect())
    expected = [(conn, i, m) for conn, _, b in rows for i, m in enumerate(b.split(b"aa")[: None if b.split(b"aa")[-1] else -1])]
    assert got == expected
    plan = split._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan
