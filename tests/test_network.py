import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowtables.functions.addresses import ipv4_number
from flowtables.operators import network, ordered, outcomes

START = datetime(2024, 1, 1)

ADDRESSES = [
    "10.0.0.0", "10.0.0.1", "10.0.0.255", "10.0.1.0", "10.0.0.7", "192.168.1.1", "256.1.1.1", "1.2.3", "::1", None, "",
    "10.0.0.01", " 10.0.0.1",
]


def kept(spark, allowlist, **options):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string")
    return [r["ip"] for r in network.ip_allowlist_filter(df, "ip", allowlist, **options).collect()]


def test_blocks_include_their_first_and_last_address(spark):
    assert kept(spark, "10.0.0.0/24") == ["10.0.0.0", "10.0.0.1", "10.0.0.255", "10.0.0.7", "10.0.0.01"]


def test_single_addresses_small_blocks_and_spaces(spark):
    assert kept(spark, " 10.0.0.7 ,192.168.1.1/32,,10.0.0.0/31") == ["10.0.0.0", "10.0.0.1", "10.0.0.7", "192.168.1.1", "10.0.0.01"]


def test_everything_block_admits_addresses_only(spark):
    assert kept(spark, "0.0.0.0/0") == ["10.0.0.0", "10.0.0.1", "10.0.0.255", "10.0.1.0", "10.0.0.7", "192.168.1.1", "10.0.0.01"]


def test_no_list_admits_all_and_rejects_none(spark):
    assert kept(spark, None) == ADDRESSES
    assert kept(spark, None, rejected=True) == []


def test_kept_and_rejected_are_complements(spark):
    for allowlist in ("10.0.0.0/24,::1", "10.0.0.4/30", ""):
        both = kept(spark, allowlist) + kept(spark, allowlist, rejected=True)
        assert sorted(map(str, both)) == sorted(map(str, ADDRESSES))


def test_malformed_entries_raise(spark):
    for bad in ("10.0.0.0/33", "10.0.0/8", "host"):
        with pytest.raises(ValueError):
            kept(spark, bad)


def test_compatible_rule(spark):
    # Inner hosts only, /31 and /32 match nothing, entries after a malformed block are lost, no trimming.
    assert kept(spark, "10.0.0.0/24", compat=True) == ["10.0.0.1", "10.0.0.7", "10.0.0.01"]
    assert kept(spark, "10.0.0.7/32,10.0.0.0/31", compat=True) == []
    assert kept(spark, "10.0.0.7,bad/block,192.168.1.1", compat=True) == ["10.0.0.7"]
    assert kept(spark, "192.168.1.1, 10.0.0.7", compat=True) == ["192.168.1.1"]


def test_many_blocks_stay_one_filter(spark):
    rng = random.Random(2)
    blocks = [(rng.randrange(2**32), rng.randint(8, 32)) for _ in range(300)]
    blocks = [((n >> (32 - p)) << (32 - p), p) for n, p in blocks]
    text = ",".join(f"{n >> 24}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255}/{p}" for n, p in blocks)
    numbers = [rng.randrange(2**32) for _ in range(400)] + [n for n, _ in blocks]
    ips = [f"{n >> 24}.{n >> 16 & 255}.{n >> 8 & 255}.{n & 255}" for n in numbers]
    df = spark.createDataFrame([(ip,) for ip in ips], "ip string")
    result = network.ip_allowlist_filter(df, "ip", text)
    expected = [ip for ip, n in zip(ips, numbers) if any(n >> (32 - p) == b >> (32 - p) for b, p in blocks)]
    assert [r["ip"] for r in result.collect()] == expected
    assert "Join" not in result._jdf.queryExecution().toString()


def test_address_numbers(spark):
    df = spark.createDataFrame([("255.255.255.255",), ("0.0.0.1",), ("1.2.3.4.5",)], "ip string")
    assert [r[0] for r in df.select(ipv4_number(F.col("ip"))).collect()] == [2**32 - 1, 1, None]


def timed_rows(seed, n=400):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(i, rng.choice("aaab"), start + timedelta(seconds=rng.randint(0, 40_000))) for i in range(n)]


@pytest.mark.parametrize("block", [60, 3600, 10**6])
def test_flow_ids_count_up_per_sender_and_epoch(spark, block):
    rows = timed_rows(1)
    df = spark.createDataFrame(rows, "id long, sender string, ts timestamp")
    got = network.assign_flow_ids(df, "sender", "ts", F.hour("ts"), ["id"], block)
    expected = {}
    for sender, epoch in {(r[1], r[2].hour) for r in rows}:
        mine = sorted((r[2], r[0]) for r in rows if (r[1], r[2].hour) == (sender, epoch))
        expected |= {i: k + 1 for k, (_, i) in enumerate(mine)}
    assert {r["id"]: r["flow_no"] for r in got.collect()} == expected


@pytest.mark.parametrize("block", [60, 3600, 10**6])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_connections_reopen_after_idle_time(spark, block, kind):
    rows = timed_rows(2)
    df = spark.createDataFrame(rows, f"id long, dest string, ts {kind}")
    got = network.assign_connections(df, "dest", "ts", 150, tie_break=["id"], block_seconds=block)
    expected = {}
    for dest in "ab":
        last, number = None, 0
        for ts, i in sorted((r[2], r[0]) for r in rows if r[1] == dest):
            number += last is None or (ts - last).total_seconds() > 150
            expected[i], last = number, ts
    assert {r["id"]: r["conn_no"] for r in got.collect()} == expected


def test_connection_per_flow(spark):
    df = spark.createDataFrame(timed_rows(3, 20), "id long, dest string, ts timestamp")
    got = network.assign_connections(df, "dest", "ts", per_flow=True, tie_break=["id"]).filter("dest = 'a'").collect()
    assert sorted(r["conn_no"] for r in got) == list(range(1, len(got) + 1))


def test_transfer_log(spark):
    df = spark.createDataFrame([("h1", 10, 1.5), ("h1", 20, 0.0), ("h2", 1, 2.0)], "host string, size long, ms double")
    log = network.transfer_log(df, "host", 6666, "ms", "size", scheme="udp")
    rows = {r["transit_uri"]: (r["flows"], r["bytes"], r["elapsed_ms"]) for r in network.transfer_log_summary(log).collect()}
    assert rows == {"udp://h1:6666": (2, 30, 1.5), "udp://h2:6666": (1, 1, 2.0)}


@pytest.mark.parametrize("port,valid", [(0, False), (1, True), (65535, True), (65536, False)])
def test_ports(spark, port, valid):
    df = spark.createDataFrame([("h", 1, 1.0)], "host string, size long, ms double")
    if valid:
        assert network.transfer_log(df, "host", port, "ms", "size").count() == 1
    else:
        with pytest.raises(ValueError):
            network.transfer_log(df, "host", port, "ms", "size")


def test_checksums(spark):
    received = spark.createDataFrame([(1, b"a"), (1, b"a"), (2, b"x"), (9, b"z")], "flow_id long, content binary")
    expected = spark.createDataFrame(
        [(1, "0cc175b9c0f1b6a831c399e269772661"), (2, "0cc175b9c0f1b6a831c399e269772661"), (3, "00")], "flow_id long, md5 string"
    )
    rows = outcomes.verify_checksums(received, expected).collect()
    assert sorted((r["flow_id"], r["status"]) for r in rows) == [(1, "match"), (2, "error"), (3, "error")]


def test_outcome_counts(spark):
    df = spark.createDataFrame([("success",)] * 3 + [("error",)], "outcome string")
    assert {tuple(r) for r in outcomes.outcome_counts(df).collect()} == {("success", 3), ("error", 1)}


def test_many_flows_of_one_sender_at_one_time_are_numbered_by_measured_blocks(spark):
    rows = [(i, "s" if i % 10 else "t", START if i % 3 else START + timedelta(seconds=1), i * 7919 % 1009) for i in range(1000)]
    flows = spark.createDataFrame(rows, "id long, sender string, ts timestamp, tie long")
    plain = network.assign_flow_ids(flows, "sender", "ts", tie_break=["tie"])
    measured = network.assign_flow_ids(flows, "sender", "ts", tie_break=["tie"], block_seconds=None)
    assert measured.columns == plain.columns
    assert sorted(map(tuple, measured.collect())) == sorted(map(tuple, plain.collect()))
    widest = ordered.range_blocks(flows, ["sender"], ["ts"], blocks=8).groupBy(ordered.RANGE_BLOCK).count()
    assert widest.agg(F.max("count")).first()[0] < 300


def test_connections_by_measured_blocks(spark):
    rows = [(i, "d", START + timedelta(milliseconds=i * 7919 % 60_000)) for i in range(800)]
    flows = spark.createDataFrame(rows, "id long, dest string, ts timestamp")
    plain = network.assign_connections(flows, "dest", "ts", 0.1, tie_break=["id"])
    measured = network.assign_connections(flows, "dest", "ts", 0.1, tie_break=["id"], block_seconds=None)
    assert sorted(map(tuple, measured.collect())) == sorted(map(tuple, plain.collect()))
