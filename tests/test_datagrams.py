import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flowtables.operators import datagrams as dg
from flowtables.operators.timeouts import classify_timeouts

SCHEMA = (
    "source string, flow_id long, header_type int, counter long, n_datagrams int, payload_length long, "
    "header string, payload binary, arrival_ms long, arrival_seq long"
)


def piece(flow, counter, n=None, at=None, payload=None, header="{}", source="s", length=None, kind=None, seq=None):
    payload = bytes([65 + counter % 26]) if payload is None else payload
    first = kind == 0 or (kind is None and counter == 0)
    at = counter if at is None else at
    return (
        source, flow, 0 if first else 1, counter, n if first else None, (n if length is None else length) if first else None,
        header if first else None, payload, at, at if seq is None else seq,
    )


def table(spark, pieces):
    return spark.createDataFrame(pieces, SCHEMA)


def flows(spark, contents, attributes=None):
    rows = [(i, attributes or {"filename": f"f{i}"}, c, len(c), "s") for i, c in enumerate(contents)]
    return spark.createDataFrame(
        rows, "flow_id long, attributes map<string,string>, content binary, size long, source string"
    )


CONTENTS = [b"", b"x", bytes(range(256)) * 5, b"abc" * 333, b"y" * 434, b"y" * 433, b"y" * 435, b"z" * 5000]


@pytest.mark.parametrize("profile,size", [("v0", 512), ("v0", 1500), ("legacy", None)])
def test_cut_shuffle_repeat_and_reassemble(spark, profile, size):
    sent = dg.packetize(flows(spark, CONTENTS), size, profile)
    doubled = sent.unionByName(sent.filter("counter % 2 = 0")).orderBy(F.rand(3))
    rows = {r["flow_id"]: r for r in dg.reassemble(doubled, profile=profile).collect()}
    for i, content in enumerate(CONTENTS):
        assert rows[i]["content"] == content and rows[i]["length_ok"] and rows[i]["outcome"] == "success"
        assert rows[i]["attributes"] == {"filename": f"f{i}"}


@pytest.mark.parametrize("profile", ["v0", "legacy"])
def test_packets_survive_the_wire(spark, profile):
    sent = dg.packetize(flows(spark, CONTENTS), None, profile)
    parsed = dg.parse_packets(dg.encode_packets(sent, profile).select("source", "packet"), profile=profile)
    rows = {r["flow_id"]: r["content"] for r in dg.reassemble(parsed, profile=profile).collect()}
    assert rows == dict(enumerate(CONTENTS))


def test_datagrams_keep_to_the_size(spark):
    sent = dg.encode_packets(dg.packetize(flows(spark, CONTENTS), 512))
    assert sent.select(F.max(F.octet_length("packet"))).first()[0] == 512 - 28


def test_header_that_does_not_fit_fails(spark):
    big = dg.packetize(flows(spark, [b"abc"], {"k": "x" * 500}), 512).collect()
    assert [(r["outcome"], r["counter"], r["payload"]) for r in big] == [("failure", None, None)]


def test_header_that_fits_exactly(spark):
    header = 512 - 28 - 24 - len('{"k":""}')
    rows = dg.packetize(flows(spark, [b"abc"], {"k": "x" * header}), 512).orderBy("counter").collect()
    assert [(r["counter"], r["payload"], r["n_datagrams"]) for r in rows] == [(0, b"", 2), (1, b"abc", 2)]


def test_parse_packets_kinds(spark):
    def packet(*parts):
        return b"".join(parts)

    i4 = lambda v: v.to_bytes(4, "big", signed=True)
    i8 = lambda v: v.to_bytes(8, "big", signed=True)
    packets = [
        packet(i4(0), i4(2), i8(3), i4(7), i4(1), b"{}", b"abc"),
        packet(i4(0), i4(50), i8(3), i4(7), i4(1), b"{}", b"abc"),  # header longer than the datagram
        packet(i4(0), i4(-1), i8(3), i4(7), i4(1), b"{}"),
        packet(i4(1), i4(-5), i8(2**40), b"d"),
        packet(i4(1), i4(7)),
        packet(i4(3), i4(1), i8(1), i4(1)),
        b"\0\0",
        b"",
        packet(i4(1), i4(7), i8(1), b"d" * 2000),
    ]
    df = spark.createDataFrame([Row(i=i, packet=p) for i, p in enumerate(packets)], "i int, packet binary")
    rows = [r for r in dg.parse_packets(df).orderBy("i").collect()]
    assert [r["kind"] for r in rows] == [
        "first", "malformed", "malformed", "data", "malformed", "unknown_type", "malformed", "malformed", "data",
    ]
    assert (rows[0]["header"], rows[0]["payload"], rows[0]["payload_length"]) == ("{}", b"abc", 3)
    assert (rows[3]["flow_id"], rows[3]["counter"]) == (-5, 2**40)
    # Nothing is cut unless a buffer size is given, and then it shows.
    assert len(rows[8]["payload"]) == 2000
    kinds = [r["kind"] for r in dg.parse_packets(df, max_size=1500).orderBy("i").collect()]
    assert kinds == [*(r["kind"] for r in rows[:8]), "cut"]


def result(spark, pieces, **options):
    return {r["flow_id"]: r for r in dg.reassemble(table(spark, pieces), **options).collect()}


def test_incomplete_flow_is_an_error_and_orphan_is_silent(spark):
    rows = result(spark, [piece(1, 0, 3), piece(1, 2), piece(2, 1), piece(2, 2)])
    assert list(rows) == [1]
    assert (rows[1]["outcome"], rows[1]["reason"], rows[1]["content"]) == ("error", "incomplete", None)


def test_stray_pieces_beyond_the_announced_number_are_ignored(spark):
    rows = result(spark, [piece(1, 0, 2), piece(1, 1), piece(1, 2), piece(1, 9), piece(2, 0, 3), piece(2, 1), piece(2, 7)])
    assert rows[1]["content"] == b"AB" and rows[1]["length_ok"]
    assert rows[2]["reason"] == "incomplete"


def test_last_arrival_wins(spark):
    pieces = [piece(1, 0, 2), piece(1, 1, payload=b"old", at=5), piece(1, 1, payload=b"new", at=9), piece(1, 0, 2, at=7)]
    assert result(spark, pieces)[1]["content"] == b"Anew"
    kept = {r["counter"]: r["payload"] for r in dg.dedupe_datagrams(table(spark, pieces)).collect()}
    assert kept == {0: b"A", 1: b"new"}


def test_equal_ids_of_two_senders_do_not_mix(spark):
    pieces = [piece(1, 0, 2), piece(1, 1), piece(1, 0, 2, source="t", payload=b"x")]
    rows = dg.reassemble(table(spark, pieces)).collect()
    assert {(r["source"], r["outcome"], r["content"]) for r in rows} == {("s", "success", b"AB"), ("t", "error", None)}


def test_wrong_length_is_flagged_and_bad_header_is_an_error(spark):
    rows = result(spark, [piece(1, 0, 1, length=5), piece(2, 0, 1, header="[1]"), piece(3, 0, 1, header="")])
    assert rows[1]["outcome"] == "success" and rows[1]["length_ok"] is False
    assert rows[2]["reason"] == "bad_header"
    assert rows[3]["outcome"] == "success" and rows[3]["attributes"] is None


def test_oversize_flow_is_reported_and_read_in_chunks(spark):
    pieces = [piece(1, 0, 5)] + [piece(1, i) for i in range(1, 5)] + [piece(2, 0, 3), piece(2, 1), piece(2, 2), piece(2, 4)]
    rows = result(spark, pieces, max_blob_bytes=3)
    assert (rows[1]["outcome"], rows[1]["reason"]) == ("error", "oversize")
    assert rows[2]["content"] == b"ABC"
    chunks = dg.reassemble(table(spark, pieces), output="chunks").orderBy("flow_id", "counter").collect()
    assert [(r["flow_id"], r["payload"]) for r in chunks] == [(1, c) for c in (b"A", b"B", b"C", b"D", b"E")] + [
        (2, c) for c in (b"A", b"B", b"C")
    ]


def test_the_limit_of_a_cell_is_in_bytes(spark):
    pieces = [piece(1, i, 5) for i in range(5)] + [piece(2, i, 3, payload=b"q" * 1200) for i in range(3)]
    rows = result(spark, pieces, max_blob_bytes=3000)
    assert rows[1]["content"] == b"ABCDE"
    assert rows[2]["reason"] == "oversize"


@pytest.mark.parametrize("profile,size", [("v0", 512), ("legacy", 600)])
@pytest.mark.parametrize("part_pieces", [1, 2, 1000])
def test_flows_as_parts(spark, profile, size, part_pieces):
    sent = dg.packetize(flows(spark, CONTENTS), size, profile).drop("outcome")
    doubled = sent.unionByName(sent.filter("counter % 2 = 0")).orderBy(F.rand(5))
    parts = dg.reassemble_parts(doubled, profile=profile, part_pieces=part_pieces).collect()
    whole = {}
    for p in sorted(parts, key=lambda p: (p["flow_id"], p["part_no"])):
        content = whole.setdefault(p["flow_id"], b"")
        assert len(content) == p["offset"] and p["outcome"] == "success" and p["length_ok"]
        assert (p["attributes"] is not None) == (p["part_no"] == 0)
        assert p["size"] == len(CONTENTS[p["flow_id"]])
        whole[p["flow_id"]] = content + p["content"]
    assert whole == dict(enumerate(CONTENTS))


def test_parts_of_broken_flows(spark):
    pieces = [piece(1, 0, 3), piece(1, 2)]  # a gap
    pieces += [piece(2, 0, 2), piece(2, 1), piece(2, 2), piece(2, 9)]  # strays, in the last part and beyond it
    pieces += [piece(3, 0, 1, header="[1]"), piece(4, 1), piece(5, 0, 1, length=7)]
    pieces += [piece(6, 0, 2), piece(6, 1, payload=b"old", seq=1), piece(6, 1, payload=b"newer", seq=2)]
    rows = dg.reassemble_parts(table(spark, pieces), part_pieces=3).collect()
    found = {r["flow_id"]: (r["part_no"], r["offset"], r["content"], r["size"], r["reason"], r["length_ok"]) for r in rows}
    assert len(rows) == len(found)
    assert found == {
        1: (0, None, None, None, "incomplete", None),
        2: (0, 0, b"AB", 2, None, True),
        3: (0, None, None, None, "bad_header", None),
        5: (0, 0, b"A", 1, None, False),
        6: (0, 0, b"Anewer", 6, None, False),
    }
    assert dg.reassemble_parts(table(spark, [])).count() == 0


def test_unknown_types_and_negative_counters_are_no_pieces(spark):
    pieces = [piece(1, 0, 1), ("s", 1, 3, 4, None, None, None, b"", 1, 1), piece(1, -1, kind=1, payload=b"z")]
    assert result(spark, pieces)[1]["content"] == b"A"


def random_arrivals(rng, flow_count=12, block=dg.COUNTER_BLOCK):
    pieces, n_of, arrived = [], {}, {}
    for flow in range(flow_count):
        n = rng.choice([1, 2, 7, 50, block - 1, block, block + 1, 2 * block + 3])
        n_of[flow] = n
        got = {c for c in range(n) if rng.random() > rng.choice([0, 0.001, 0.3])}
        got |= {n + 3} if rng.random() < 0.3 else set()
        arrived[flow] = got
        for c in got:
            pieces += [piece(flow, c, n, at=rng.randint(0, 5000), payload=b"p")] * rng.choice([1, 1, 2])
    rng.shuffle(pieces)
    return pieces, n_of, arrived


def test_gap_operators_against_brute_force(spark):
    rng = random.Random(5)
    pieces, n_of, arrived = random_arrivals(rng)
    df = table(spark, pieces).cache()
    announced = {f for f, got in arrived.items() if 0 in got}

    missing = {(r["flow_id"], r["counter"]) for r in dg.missing_datagrams(df).collect()}
    assert missing == {(f, c) for f in announced for c in range(n_of[f]) if c not in arrived[f]}

    orphans = {(r["flow_id"], r["counter"]) for r in dg.orphan_datagrams(df).collect()}
    assert orphans == {(f, c) for f in arrived if f not in announced for c in arrived[f]}

    def boundary(got):
        r = -1
        while r + 1 in got:
            r += 1
        return r

    prefix = {r["flow_id"]: r["right_boundary"] for r in dg.contiguous_prefix(df).collect()}
    assert prefix == {f: boundary(got) for f, got in arrived.items() if got}

    status = {r["flow_id"]: (r["arrived"], r["outcome"]) for r in dg.flow_status(df).collect()}
    for f in announced:
        below = len([c for c in arrived[f] if c < n_of[f]])
        assert status[f] == (below, "success" if below == n_of[f] else "error")

    first = {}
    for p in pieces:
        first[p[1], p[3]] = min(first.get((p[1], p[3]), 10**9), p[8])
    expected = set()
    for f, got in arrived.items():
        latest = -1
        for c in range(boundary(got) + 1):
            latest = max(latest, first[f, c])
            expected.add((f, c, latest))
    progress = dg.prefix_progress(df, at="arrival_ms").collect()
    assert {(r["flow_id"], r["counter"], r["usable_ms"]) for r in progress} == expected


def walk_writer(n, first, timeout, flush):
    """The writer, step by step."""
    if 0 not in first:
        return None
    clock, left, right = first[0], 0, -1
    for now in sorted(set(first.values())):
        if now < first[0]:
            continue
        if now - clock > timeout:
            return "timeout"
        while right + 1 < n and right + 1 in first and first[right + 1] <= now:
            right += 1
        if (right == n - 1 and left <= right) or right - left >= flush - 1:
            left, clock = right + 1, now
        if left >= n:
            return "success"
    return "timeout"


@pytest.mark.parametrize("flush,span", [(5, 16), (5, 7), (11, 1000), (3, 3)])
def test_timeouts_against_the_step_by_step_writer(spark, flush, span):
    rng = random.Random(flush * span)
    pieces, expected = [], {}
    for flow in range(120):
        n = rng.choice([1, 3, flush - 1, flush, flush + 1, 2 * flush, 40, 97])
        step = rng.choice([5, 20, 60])
        first = {c: max(0, c * step + rng.randint(-100, 100)) for c in range(n) if rng.random() > 0.002}
        pieces += [piece(flow, c, n, at=t, payload=b"") for c, t in first.items()]
        expected[flow] = walk_writer(n, first, 300, flush)
    rng.shuffle(pieces)
    got = classify_timeouts(table(spark, pieces), 300, at="arrival_ms", flush_pieces=flush, span=span).collect()
    assert {r["flow_id"]: r["outcome"] for r in got} == {f: o for f, o in expected.items() if o}
    assert set(expected.values()) >= {"success", "timeout"}


@pytest.mark.parametrize("n", [1001, 1002, 2002, 2003])
def test_timeout_at_the_real_flush_size(spark, n):
    first = {c: c * 3 for c in range(n)}
    got = classify_timeouts(table(spark, [piece(1, c, n, at=t, payload=b"") for c, t in first.items()]), 3001, at="arrival_ms")
    assert got.first()["outcome"] == walk_writer(n, first, 3001, 1001)


def test_statistics(spark):
    df = table(spark, [piece(1, 0, 2, at=0, payload=b"ab"), piece(1, 1, at=500, payload=b"c"), piece(2, 0, 1, at=9)])
    rows = {r["flow_id"]: r for r in dg.transfer_stats(df, at="arrival_ms").collect()}
    assert (rows[1]["datagrams"], rows[1]["bytes"], float(rows[1]["elapsed_s"])) == (2, 2 + 1 + 16, 0.5)
    assert float(rows[1]["pps"]) == 4.0 and float(rows[1]["mbit"]) == pytest.approx(19 * 8 / 0.5 / 1e6)
    assert rows[2]["pps"] is None and rows[2]["mbit"] is None
    totals = dg.receiver_totals(df, at="arrival_ms").first()
    assert (totals["datagrams"], totals["first_ms"], totals["last_ms"], totals["running_ms"]) == (3, 0, 500, 500)
    assert dg.receiver_totals(df, at="arrival_ms", subtotals=True).count() == 4


def test_pacing(spark):
    df = spark.range(5).withColumnRenamed("id", "counter")
    sent = [r["send_ms"] for r in dg.pacing_schedule(df, 100).orderBy("counter").collect()]
    assert sent == [0.0, 0.0, 20.0, 30.0, 40.0]
    with pytest.raises(ValueError):
        dg.pacing_schedule(df, 0)


def test_uneven_pieces_of_a_small_flow_are_put_together(spark):
    # One long piece at a high counter: its counter times its length is far above the limit, the flow is not.
    pieces = [piece(1, c, 1000, payload=b"x" * 10) for c in range(1000) if c != 900] + [piece(1, 900, payload=b"y" * 6000)]
    pieces += [piece(2, c, 20, payload=b"z" * 1000) for c in range(20)] + [piece(2, 40, payload=b"stray")]
    pieces += [piece(3, c, 3, payload=b"q" * 9000) for c in range(3)]
    rows = {r["flow_id"]: r for r in dg.reassemble(table(spark, pieces), max_blob_bytes=20_000).collect()}
    assert rows[1]["content"] == b"x" * 9000 + b"y" * 6000 + b"x" * 990
    assert rows[2]["content"] == b"z" * 20_000
    assert (rows[3]["outcome"], rows[3]["reason"], rows[3]["content"]) == ("error", "oversize", None)
