"""Address lists as tables, and checksums of flows in parts."""

import hashlib
import ipaddress
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowtables.operators import network, outcomes

START = datetime(2024, 1, 1)
BLOCKS = "entry string, admits boolean, valid_from timestamp, valid_to timestamp"


def test_the_longest_valid_block_decides(spark):
    rng = random.Random(1)
    blocks = []
    for _ in range(300):
        length = rng.choice([0, 8, 15, 16, 20, 24, 29, 31, 32])
        entry = f"10.{rng.randrange(2)}.{rng.randrange(4)}.{rng.randrange(256)}" + (f"/{length}" if length < 32 or rng.random() < 0.5 else "")
        begin = START + timedelta(hours=rng.randrange(48)) if rng.random() < 0.6 else None
        end = (begin or START) + timedelta(hours=rng.randrange(20)) if rng.random() < 0.6 else None
        blocks.append((rng.choice(["", " "]) + entry, rng.choice([True, True, False, None]), begin, end))
    rows = [(i, f"10.{rng.randrange(3)}.{rng.randrange(5)}.{rng.randrange(256)}", START + timedelta(minutes=rng.randrange(3000)), 0) for i in range(800)]
    rows += [(900, None, START, 0), (901, "no address", START, 0), (902, "10.0.0.256", START, 0), (903, "10.0.0.1", None, 0)]
    df = spark.createDataFrame(rows, "id long, ip string, ts timestamp, number int")
    table = spark.createDataFrame(blocks, BLOCKS)
    parsed = [(ipaddress.IPv4Network(e.strip(), strict=False), a is not False, b, t) for e, a, b, t in blocks]

    def admitted(ip, ts, timed):
        try:
            address = ipaddress.IPv4Address(ip)
        except ipaddress.AddressValueError:
            return False
        own = [
            (-net.prefixlen, a) for net, a, b, t in parsed
            if address in net and (not timed or ((b is None or (ts is not None and b <= ts)) and (t is None or (ts is not None and ts < t))))
        ]
        return min(own)[1] if own else False

    for at in ("ts", None):
        expected = {i for i, ip, ts, _ in rows if admitted(ip, ts, at is not None)}
        got = network.ip_table_filter(df, "ip", table, at=at)
        assert got.columns == df.columns
        assert {r["id"] for r in got.collect()} == expected and 100 < len(expected) < 700
        others = network.ip_table_filter(df, "ip", table, at=at, rejected=True)
        assert {r["id"] for r in others.collect()} == {r[0] for r in rows} - expected


def test_plain_tables_and_empty_ones(spark):
    df = spark.createDataFrame([(1, "10.0.0.1"), (2, "10.0.1.1"), (2, "10.0.1.1"), (3, None)], "id long, ip string")
    one = spark.createDataFrame([("10.0.1.0/24",), ("10.0.1.0/24",)], "entry string")
    assert [r["id"] for r in network.ip_table_filter(df, "ip", one).collect()] == [2, 2]
    none = one.limit(0)
    assert network.ip_table_filter(df, "ip", none).count() == 0 and network.ip_table_filter(df, "ip", none, rejected=True).count() == 4
    for wrong in ("10.0.0.0/33", "10.0.0/8", "host", None, "10.0.0.0/8/8"):
        with pytest.raises(Exception, match="not an IPv4 block"):
            network.ip_table_filter(df, "ip", spark.createDataFrame([(wrong,)], "entry string")).collect()


def tree_of(data, leaf, fan, levels):
    nodes = [hashlib.md5(data[i : i + leaf]).digest() for i in range(0, max(len(data), 1), leaf)]
    for _ in range(levels):
        nodes = [hashlib.md5(b"".join(nodes[i : i + fan])).digest() for i in range(0, len(nodes), fan)]
    assert len(nodes) == 1
    return nodes[0].hex()


def test_tree_checksums_do_not_depend_on_parts(spark):
    rng = random.Random(2)
    flows = {i: bytes(rng.randrange(256) for _ in range(n)) for i, n in enumerate([0, 1, 15, 16, 17, 32, 100, 1000, 1023])}
    tree = {"leaf_bytes": 16, "fan": 3, "levels": 4}
    expected = {i: tree_of(data, 16, 3, 4) for i, data in flows.items()}
    for width in (1, 7, 16, 48, 5000):
        rows = [(i, at, data[at : at + width]) for i, data in flows.items() for at in range(0, max(len(data), 1), width)]
        rng.shuffle(rows)
        parts = spark.createDataFrame(rows + rows[:5], "flow_id long, offset long, content binary")
        got = {r["flow_id"]: r["tree_md5"] for r in outcomes.tree_checksums(parts, **tree).collect()}
        assert got == expected
    sums = spark.createDataFrame([*expected.items(), (99, "0" * 32)], "flow_id long, tree_md5 string")
    damaged = parts.filter("flow_id <> 3").withColumn(
        "content", F.when(F.col("flow_id") == 7, F.encode(F.lit("other"), "UTF-8")).otherwise(F.col("content"))
    )
    status = {r["flow_id"]: r["status"] for r in outcomes.verify_checksums_parts(damaged, sums, **tree).collect()}
    assert {i for i, s in status.items() if s == "error"} == {3, 7, 99} and len(status) == 10
