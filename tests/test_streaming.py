import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowtables.operators import datagrams as dg
from flowtables.operators import framed
from flowtables.operators.timeouts import classify_timeouts
from flowtables.streaming.framed import stream_cut_frames
from flowtables.streaming.reassembly import stream_reassemble
from flowtables.streaming.settings import prepare
from flowtables.streaming.windows import stream_dedupe, stream_raw_sessions, stream_throughput
from test_datagrams import SCHEMA, piece
from test_framed import STREAM, frame, segments

START = datetime(2024, 1, 1)
TIMED = SCHEMA + ", arrival_ts timestamp"


@pytest.fixture
def run(spark, tmp_path):
    """Stream batches of rows, one file and micro-batch each, and return what came out."""
    prepare(spark)

    def go(batches, transform):
        landing = str(tmp_path / "in")
        for batch in batches:
            batch.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(landing)
        query = (
            transform(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.read.schema(transform(stream).schema).parquet(str(tmp_path / "out")).collect()

    return go


def timed(spark, pieces):
    rows = [(*p, START + timedelta(milliseconds=p[8])) for p in pieces]
    return spark.createDataFrame(rows, TIMED)


def keepalive(spark):
    return timed(spark, [("", 0, 3, 0, None, None, None, b"", 40 * 86_400_000, 0)])


def test_flows_over_several_batches(spark, run):
    batches = [
        [piece(1, 2, at=0), piece(2, 0, 1, at=1), piece(3, 0, 2, at=1), piece(5, 1, at=2), piece(6, 4, at=2), piece(6, 1, at=2)],
        [piece(1, 0, 3, at=10), piece(2, 0, 1, at=11), piece(4, 0, 2, header="[]", at=9), piece(4, 1, at=9), piece(6, 0, 2, at=12)],
        [piece(1, 1, at=20), piece(1, 1, at=21), piece(3, 0, 2, at=22)],
        [piece(1, 0, 3, at=30), piece(1, 2, at=31)],
    ]
    frames = [timed(spark, b) for b in batches] + [keepalive(spark)]
    rows = run(frames, lambda s: stream_reassemble(s, 60_000, "10 seconds"))
    got = sorted((r["flow_id"], r["outcome"], r["reason"], r["content"]) for r in rows)
    assert got == [
        (1, "success", None, b"ABC"), (2, "success", None, b"A"), (3, "error", "timeout", None),
        (4, "error", "bad_header", None), (6, "success", None, b"AB"),
    ]
    assert all(r["length_ok"] and r["attributes"] == {} for r in rows if r["outcome"] == "success")


def test_oversize_flow_is_not_buffered(spark, run):
    batches = [timed(spark, [piece(1, 9), piece(1, 1)]), timed(spark, [piece(1, 0, 20, at=3), piece(1, 2, at=4)])]
    rows = run(batches, lambda s: stream_reassemble(s, max_blob_bytes=5))
    assert [(r["outcome"], r["reason"]) for r in rows] == [("error", "oversize")]


def test_flows_are_bounded_by_bytes_and_not_by_pieces(spark, run):
    many = [piece(1, c, 40, payload=b"x") for c in range(40)] + [piece(1, 10**12, payload=b"")]
    # Announced as small, but more comes than fits; and as large, before most of it has come.
    lying = [piece(2, c, 5, payload=b"y" * 20, length=9) for c in range(5)]
    rows = run([timed(spark, lying[1:] + many[:20]), timed(spark, many[20:] + lying[:1])], lambda s: stream_reassemble(s, max_blob_bytes=50))
    got = sorted((r["flow_id"], r["outcome"], r["reason"], r["content"]) for r in rows)
    assert got == [(1, "success", None, b"x" * 40), (2, "error", "oversize", None)]


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_agrees_with_batch(spark, run, parts):
    rng = random.Random(parts)
    pieces = []
    for flow in range(40):
        n = rng.choice([1, 2, 5, 6, 12, 30])
        step = rng.choice([5, 30, 80])
        for c in range(n):
            if rng.random() > 0.01:
                at = c * step + rng.randint(0, 20)
                pieces += [piece(flow, c, n, at=at, header=f'{{"f":"{flow}"}}')] * rng.choice([1, 1, 2])
    pieces.sort(key=lambda p: p[8])
    size = -(-len(pieces) // parts)
    df = timed(spark, pieces)
    batches = [timed(spark, pieces[i : i + size]) for i in range(0, len(pieces), size)] + [keepalive(spark)]
    rows = run(batches, lambda s: stream_reassemble(s, 200, "1 hour", flush_pieces=5))
    on_time = {
        r["flow_id"]: r["outcome"] == "success" for r in classify_timeouts(df, 200, at="arrival_ms", flush_pieces=5).collect()
    }
    whole = {r["flow_id"]: r["content"] for r in dg.reassemble(df).collect()}
    assert {r["flow_id"]: r["content"] for r in rows} == {f: whole[f] if ok else None for f, ok in on_time.items()}
    assert len(rows) == len(on_time)


@pytest.mark.parametrize("parts", [1, 3])
def test_verdict_does_not_depend_on_the_order_of_rows(spark, run, parts):
    n = 15_000  # over six seconds, three times the time limit
    pieces = [piece(1, c, n, at=c * 6000 // n) for c in range(n)]
    # The same with a stall in the middle.
    pieces += [piece(2, c, n, at=c * 6000 // n + 2500 * (c > n // 2)) for c in range(n)]
    random.Random(parts).shuffle(pieces)
    size = -(-len(pieces) // parts)
    batches = [timed(spark, pieces[i : i + size]) for i in range(0, len(pieces), size)] + [keepalive(spark)]
    rows = run(batches, lambda s: stream_reassemble(s, 2000, "1 hour"))
    assert sorted((r["flow_id"], r["outcome"], r["reason"]) for r in rows) == [(1, "success", None), (2, "error", "timeout")]
    judged = classify_timeouts(timed(spark, pieces), 2000, at="arrival_ms").collect()
    assert {r["flow_id"]: r["outcome"] for r in judged} == {1: "success", 2: "timeout"}


def test_frames_over_batches_with_early_segments(spark, run):
    parts = [STREAM[i : i + 9] for i in range(0, len(STREAM), 9)]
    order = list(range(len(parts)))
    random.Random(1).shuffle(order)
    schema = "conn_id long, seq long, bytes binary"
    third = len(order) // 3 + 1
    batches = [
        spark.createDataFrame([(1, s, parts[s]) for s in order[i : i + third]], schema) for i in range(0, len(order), third)
    ]
    batches.append(spark.createDataFrame([(2, 0, frame()[:-1]), (3, 0, b"")], schema))
    rows = run(batches, stream_cut_frames)
    pieces = spark.createDataFrame(rows, "conn_id long, frame_no long, part string, at long, header_len long, payload_len long, bytes binary")
    got = {(r["conn_id"], r["frame_no"]): (r["content"], r["truncated"]) for r in framed.assemble_frames(pieces).collect()}
    everything = segments(spark, {1: STREAM, 2: frame()[:-1], 3: b""}, 9)
    expected = framed.segments_to_flows(everything).collect()
    assert got == {(r["conn_id"], r["frame_no"]): (r["content"], r["truncated"]) for r in expected}


def test_repeats_are_dropped_within_the_delay(spark, run):
    pieces = [piece(1, c % 5, 5, at=c, payload=b"p") for c in range(20)]
    rows = run([timed(spark, pieces[:8]), timed(spark, pieces[8:])], lambda s: stream_dedupe(s, "1 hour"))
    assert sorted(r["counter"] for r in rows) == [0, 1, 2, 3, 4]


def test_throughput_in_sliding_windows(spark, run):
    pieces = [piece(1, c, 9, at=c * 1000, payload=b"12345678") for c in range(9)]
    rows = run([timed(spark, pieces), keepalive(spark)], lambda s: stream_throughput(s.filter("header_type < 3 or arrival_ts > '2024-02-01'"), "4 seconds", "2 seconds", "1 second"))
    got = {int((r["window_start"] - START).total_seconds()): (r["n"], r["bytes"], r["pps"]) for r in rows}
    assert got[0] == (4, 8 * 4 + 16 * 3, 1.0) and got[-2] == (2, 8 * 2 + 16, 0.5) and got[6] == (3, 24 * 3, 0.75)


def test_sessions_close_after_idle_time(spark, run):
    schema = "conn_id long, seq long, bytes binary, ts timestamp"
    at = lambda s: START + timedelta(seconds=s)
    batches = [
        spark.createDataFrame([(1, 1, b"b", at(3)), (1, 0, b"a", at(0)), (2, 0, b"z", at(1))], schema),
        spark.createDataFrame([(1, 2, b"c", at(6)), (1, 3, b"d", at(20))], schema),
        spark.createDataFrame([(9, 0, b"", at(10_000))], schema),
    ]
    rows = run(batches, lambda s: stream_raw_sessions(s, watermark="1 minute"))
    got = sorted((r["conn_id"], r["n"], r["size"], bytes(r["content"])) for r in rows)
    assert got == [(1, 1, 1, b"d"), (1, 3, 3, b"abc"), (2, 1, 1, b"z")]


def test_session_totals_without_content(spark, run):
    schema = "conn_id long, seq long, bytes binary, ts timestamp"
    batch = spark.createDataFrame([(1, 0, b"ab", START), (2, 0, b"", START + timedelta(days=1))], schema)
    rows = run([batch], lambda s: stream_raw_sessions(s, watermark="1 minute", content=False))
    assert [(r["conn_id"], r["size"]) for r in rows] == [(1, 2)]


def test_windows_run_on_tables_too(spark):
    df = timed(spark, [piece(1, c, 3, at=c) for c in range(3)])
    assert stream_throughput(df, "1 minute").first()["n"] == 3
