"""Whole transfers: what goes in on one side comes out on the other, over every carrier."""

import pytest
from pyspark.sql import functions as F

from flowtables.operators import datagrams as dg
from flowtables.operators import framed
from flowtables.streaming.windows import stream_throughput

#: Bytes that could be mistaken for something: text of several bytes a character, every byte, runs of zeros, delimiters,
#: lengths around the cutting points.
TEXTS = ["größer als € 5", "日本語テキスト", "no newline", "{delimiter}", "tab\tand \\ backslash"]
WORKLOADS = {
    "texts": [t.encode() for t in TEXTS],
    "empty": [b""],
    "bytes": [bytes(range(256)) * 90],
    "many": [i.to_bytes(4, "big") * 9 for i in range(300)],
    "cuts": [b"\x00" * n for n in (1, 63, 64, 65, 599, 600, 601, 1471, 1472, 1473)] + [b""],
}


def flows(spark, contents, connections):
    rows = [(i, i % connections, {"filename": f"{i}"}, c, len(c), "10.0.0.1") for i, c in enumerate(contents)]
    schema = "flow_id long, conn_id long, attributes map<string,string>, content binary, size long, source string"
    return spark.createDataFrame(rows, schema)


def over_connections(df):
    return framed.segments_to_flows(framed.flows_to_segments(df, segment_bytes=700))


def over_versioned_connections(df):
    return framed.segments_to_flows(framed.flows_to_segments(df, profile="v0", segment_bytes=64), profile="v0")


def over_datagrams(df):
    return dg.reassemble(dg.packetize(df))


def over_packets(df):
    return dg.reassemble(dg.parse_packets(dg.encode_packets(dg.packetize(df, 600)).select("source", "packet")))


def over_legacy_datagrams(df):
    return dg.reassemble(dg.packetize(df, profile="legacy"), profile="legacy")


@pytest.mark.parametrize("workload", WORKLOADS)
@pytest.mark.parametrize(
    "carrier,connections",
    [
        (over_connections, 1),
        (over_connections, 1000),
        (over_versioned_connections, 1),
        (over_datagrams, 1),
        (over_packets, 1),
        (over_legacy_datagrams, 1),
    ],
)
def test_everything_arrives(spark, carrier, workload, connections):
    contents = WORKLOADS[workload]
    got = carrier(flows(spark, contents, connections)).collect()
    assert all(r["outcome"] == "success" for r in got)
    assert {int(r["attributes"]["filename"]): bytes(r["content"]) for r in got} == dict(enumerate(contents))
    assert len(got) == len(contents)


MESSAGES = [t for t in TEXTS if "{delimiter}" not in t]


def test_delimited_messages(spark):
    stream = b"".join(t.encode() + b"{delimiter}\r\n" for t in MESSAGES)
    df = spark.createDataFrame([(1, 0, stream[:40]), (1, 1, stream[40:])], "conn_id long, seq long, bytes binary")
    rows = framed.delimited_streams_to_flows(df, b"{delimiter}\r\n").orderBy("msg_no").collect()
    assert [bytes(r["content"]).decode() for r in rows] == MESSAGES


def test_packets_longer_than_the_buffer_do_not_pass_shortened(spark):
    sent = dg.encode_packets(dg.packetize(flows(spark, [b"y" * 20_000], 1), 9000)).select("source", "packet")
    assert [r["size"] for r in dg.reassemble(dg.parse_packets(sent)).collect()] == [20_000]
    kinds = {r["kind"]: r["n"] for r in dg.packet_counts(dg.parse_packets(sent, max_size=1500)).collect()}
    assert kinds["cut"] >= 2 and "first" not in kinds
    got = dg.reassemble(dg.parse_packets(sent, max_size=1500)).collect()
    assert all(r["outcome"] != "success" for r in got)


def test_numbers_that_do_not_fit_a_packet_fail(spark):
    both = flows(spark, [b"hello", b"world!"], 1).withColumn("flow_id", F.when(F.col("flow_id") == 0, F.lit(2**32 + 5)).otherwise(5))
    packets = dg.encode_packets(dg.packetize(both))
    failed = packets.filter("outcome = 'failure'").collect()
    assert [(r["flow_id"], r["reason"], r["packet"]) for r in failed] == [(2**32 + 5, "flow_id_range", None)]
    got = dg.reassemble(dg.parse_packets(packets.filter("packet IS NOT NULL").select("source", "packet"))).collect()
    assert [(r["flow_id"], bytes(r["content"])) for r in got] == [(5, b"world!")]


def test_keepalives_are_not_counted(spark):
    rows = [("a", 1, 0, 0, 1, b"x", "2024-01-01 00:00:00"), ("a", 1, 3, None, None, b"", "2024-01-01 00:00:05")]
    schema = "source string, flow_id long, header_type int, counter long, n_datagrams int, payload binary, at string"
    df = spark.createDataFrame(rows, schema).withColumn("arrival_ts", F.col("at").cast("timestamp"))
    assert [(r["datagrams"], r["elapsed_s"]) for r in dg.transfer_stats(df).collect()] == [(1, 0.0)]
    assert [r["n"] for r in stream_throughput(df).collect()] == [1]
