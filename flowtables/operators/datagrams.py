"""Cutting flows into datagrams and putting them back together.

A datagram row has ``source, flow_id, header_type, counter, payload``; rows of type 0 (the first of a
flow, counter 0) also carry ``n_datagrams, payload_length, header``. ``arrival_seq`` orders arrivals
where it exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions import binary, headers
from flowtables.functions.times import epoch_millis
from flowtables.operators.attributes import encode_attributes
from flowtables.operators.ordered import counter_block, running
from flowtables.schema import (
    COUNTER_BLOCK,
    ERROR,
    FAILURE,
    FLOW_KEY,
    LEGACY_DATAGRAM_SIZE,
    MAX_BLOB_BYTES,
    MAX_PACKET_BYTES,
    SUCCESS,
    datagram_profile,
)

_FLOW_COLUMNS = ("attributes", "content", "size", "header_json", "header_len")


# --- cutting -----------------------------------------------------------------------------------


def packetize(
    flows: DataFrame, datagram_size: int | None = None, profile: str = "v0", typed: bool = False
) -> DataFrame:
    """O31, O32. One row per datagram of each flow, plus one ``failure`` row per flow whose header does not fit.

    The first datagram holds the header and as much content as fits, the others hold content only.
    All other columns of ``flows`` are kept.
    """
    sizes = datagram_profile(profile)
    size = datagram_size or (LEGACY_DATAGRAM_SIZE if profile == "legacy" else MAX_PACKET_BYTES)
    if profile == "legacy":
        room = size  # the data header comes on top
    else:
        room = size - sizes.data_header - sizes.network_header
    if room <= 0:
        raise ValueError(f"datagram_size {size} leaves no room for data")

    kept = [c for c in flows.columns if c not in _FLOW_COLUMNS]
    first_room = F.lit(size - sizes.first_header - sizes.network_header) - F.col("header_len")
    rest = F.greatest(F.col("size") - F.col("_fill"), F.lit(0))
    later = F.ceil(rest / F.lit(room)).cast("int")

    measured = (
        encode_attributes(flows, typed)
        .withColumn("_fill", first_room)
        .withColumn("_later", later)
        .withColumn("_counters", F.when(F.col("_fill") >= 0, F.sequence(F.lit(0).cast("bigint"), F.col("_later").cast("bigint"))))
    )
    counter = F.col("counter")
    first = counter == 0
    offset = F.when(first, F.lit(0)).otherwise(F.col("_fill") + (counter - 1) * room)
    length = F.when(first, F.col("_fill")).otherwise(F.lit(room))
    announced = F.col("_later") + F.lit(1 if sizes.announces_first else 0)
    return measured.select(
        *kept, "content", "size", "header_json", "_fill", "_later", F.explode_outer("_counters").alias("counter")
    ).select(
        *kept,
        F.when(counter.isNotNull(), announced).cast("int").alias("n_datagrams"),
        "counter",
        F.when(first, 0).when(counter.isNotNull(), 1).alias("header_type"),
        F.when(first, F.col("size")).alias("payload_length"),
        F.when(first, F.coalesce("header_json", F.lit(""))).alias("header"),
        F.when(counter.isNotNull(), binary.slice_bytes(F.col("content"), offset, length)).alias("payload"),
        F.when(counter.isNull(), FAILURE).otherwise(SUCCESS).alias("outcome"),
    )


def encode_packets(datagrams: DataFrame, profile: str = "v0") -> DataFrame:
    """Add ``packet``, the bytes of each datagram as they travel, with ``outcome`` and ``reason``.

    A packet has 32 bits for the flow's number and for how many datagrams it has (the legacy one also for the counter).
    Flows out of that range cannot be sent: their packets are null, ``outcome`` is ``failure``.
    """
    sizes = datagram_profile(profile)
    header = binary.utf8_bytes(F.col("header"))
    first = F.concat(
        binary.int32_bytes(F.lit(0)),
        binary.int32_bytes(F.octet_length(header)),
        binary.int64_bytes(F.col("payload_length")),
        binary.int32_bytes(F.col("flow_id")),
        binary.int32_bytes(F.col("n_datagrams")),
        header,
        F.col("payload"),
    )
    counter = F.col("counter")
    data = F.concat(
        binary.int32_bytes(F.lit(1)),
        binary.int32_bytes(F.col("flow_id")),
        binary.int64_bytes(counter) if sizes.counter_bytes == 8 else binary.int32_bytes(counter),
        F.col("payload"),
    )
    fits = F.col("flow_id").between(-(2**31), 2**31 - 1)
    counted = F.coalesce(F.col("n_datagrams").between(0, 2**31 - 1), F.lit(True))
    if sizes.counter_bytes == 4:
        counted = counted & F.coalesce(counter.between(0, 2**31 - 1), F.lit(True))
    packet = F.when(fits & counted, F.when(F.col("header_type") == 0, first).otherwise(data))
    before = F.col("outcome") if "outcome" in datagrams.columns else F.lit(SUCCESS)
    return (
        datagrams.withColumn("packet", packet)
        .withColumn("outcome", F.when(fits & counted, before).otherwise(FAILURE))
        .withColumn("reason", F.when(~fits, "flow_id_range").when(~counted, "datagram_count_range"))
    )


def parse_packets(
    packets: DataFrame, packet_col: str = "packet", max_size: int | None = None, profile: str = "v0"
) -> DataFrame:
    """O39. Raw packets to datagram rows with a ``kind``: ``first``, ``data``, ``cut``, ``unknown_type`` or ``malformed``.

    A receive buffer of ``max_size`` bytes loses what is beyond it. Such packets are ``cut``: their flows miss a piece
    rather than pass with a shortened one. Only ``first`` and ``data`` rows are datagrams.
    """
    sizes = datagram_profile(profile)
    kept = [c for c in packets.columns if c != packet_col]
    data = F.col("_data")
    length, header_len = F.octet_length(data), F.col("_header_len")
    typed = packets.withColumn("_data", F.col(packet_col)).withColumn(
        "_type", F.when(length >= 4, binary.int32_at(data, 1))
    )
    typed = typed.withColumn(
        "_header_len", F.when((F.col("_type") == 0) & (length >= sizes.first_header), binary.int32_at(data, 5))
    )
    whole_header = (header_len >= 0) & (length >= sizes.first_header + header_len)
    too_long = F.lit(False) if max_size is None else F.coalesce(length > max_size, F.lit(False))
    kind = (
        F.when(too_long, "cut")
        .when(F.col("_type").isNull(), "malformed")
        .when(F.col("_type") == 0, F.when(whole_header, "first").otherwise("malformed"))
        .when(F.col("_type") == 1, F.when(length >= sizes.data_header, "data").otherwise("malformed"))
        .otherwise("unknown_type")
    )
    typed = typed.withColumn("kind", kind)
    first, later = F.col("kind") == "first", F.col("kind") == "data"
    count = binary.int64_at(data, 9) if sizes.counter_bytes == 8 else binary.int32_at(data, 9)
    after_header = sizes.first_header + header_len
    return typed.select(
        *(c for c in kept if c not in ("flow_id", "counter", "header_type")),
        "kind",
        F.when(first, 0).when(later, 1).alias("header_type"),
        F.when(first, binary.int32_at(data, 17)).when(later, binary.int32_at(data, 5)).alias("flow_id"),
        F.when(first, F.lit(0)).when(later, count).cast("bigint").alias("counter"),
        F.when(first, binary.int32_at(data, 21)).cast("int").alias("n_datagrams"),
        F.when(first, binary.int64_at(data, 9)).alias("payload_length"),
        F.when(
            first, F.decode(binary.slice_bytes(data, F.lit(sizes.first_header), header_len), "UTF-8")
        ).alias("header"),
        F.when(first, binary.slice_bytes(data, after_header, length - after_header))
        .when(later, binary.slice_bytes(data, F.lit(sizes.data_header), length - sizes.data_header))
        .alias("payload"),
    )


def packet_counts(parsed: DataFrame) -> DataFrame:
    """Packets and payload bytes by kind."""
    return parsed.groupBy("kind").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("payload_bytes")
    )


# --- the pieces of a flow ----------------------------------------------------------------------


def _arrival_order(datagrams: DataFrame) -> Column:
    return F.col("arrival_seq") if "arrival_seq" in datagrams.columns else F.lit(0).cast("bigint")


def _pieces(datagrams: DataFrame) -> DataFrame:
    """First datagrams are piece 0, data datagrams are pieces 1, 2 ...; anything else is no piece."""
    return datagrams.filter(
        ((F.col("header_type") == 0) & (F.col("counter") == 0)) | ((F.col("header_type") == 1) & (F.col("counter") > 0))
    )


def announcements(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, profile: str = "v0") -> DataFrame:
    """One row per announced flow, from its latest first datagram: ``n``, ``payload_length``, ``header``."""
    extra = 0 if datagram_profile(profile).announces_first else 1
    latest = F.max(F.struct(_arrival_order(datagrams).alias("s"), "n_datagrams", "payload_length", "header"))
    return (
        datagrams.filter(F.col("header_type") == 0)
        .groupBy(*key)
        .agg(latest.alias("a"))
        .select(*key, (F.col("a.n_datagrams") + extra).cast("bigint").alias("n"), "a.payload_length", "a.header")
    )


def counter_blocks(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """The distinct counters that arrived, as sorted arrays: one row per flow and block of counters.

    Repeats vanish before the shuffle, a huge flow is spread over its blocks, no payload is read.
    """
    return (
        _pieces(datagrams)
        .groupBy(*key, counter_block().alias("block"))
        .agg(F.sort_array(F.collect_set("counter")).alias("counters"))
    )


def dedupe_datagrams(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """O24. One row per flow and counter; the last arrival wins.

    Spark keeps one row of each group per task before the shuffle, so even endless copies of one piece travel once.
    """
    arrivals = Window.partitionBy(*key, "counter").orderBy(_arrival_order(datagrams).desc())
    return datagrams.withColumn("_copy", F.row_number().over(arrivals)).filter("_copy = 1").drop("_copy")


def flow_status(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, profile: str = "v0") -> DataFrame:
    """Outcome of each announced flow without touching payloads: ``n``, ``arrived``, ``outcome``, ``reason``."""
    announced = announcements(datagrams, key, profile)
    arrived = counter_blocks(datagrams, key).join(announced.select(*key, "n"), list(key))
    below = F.size(F.filter("counters", lambda c: c < F.col("n")))
    counts = arrived.groupBy(*key).agg(F.sum(below).alias("arrived"))
    joined = announced.join(counts, list(key), "left").withColumn("arrived", F.coalesce("arrived", F.lit(0)))
    joined = joined.withColumn("attributes", headers.header_attributes(F.col("header")))
    return joined.select(*key, "n", "payload_length", "attributes", "arrived", *_verdict(F.col("arrived") == F.col("n")))


def _verdict(complete: Column, oversize: Column | None = None) -> list[Column]:
    bad_header = (F.octet_length("header") > 0) & F.col("attributes").isNull()
    reason = F.when(oversize, "oversize") if oversize is not None else F
    reason = reason.when(~complete, "incomplete").when(bad_header, "bad_header")
    return [F.when(reason.isNull(), SUCCESS).otherwise(ERROR).alias("outcome"), reason.alias("reason")]


def reassemble(
    datagrams: DataFrame,
    key: Sequence[str] = FLOW_KEY,
    output: str = "blob",
    profile: str = "v0",
    max_blob_bytes: int = MAX_BLOB_BYTES,
) -> DataFrame:
    """O19. Put flows back together from pieces that may repeat, be lost or come in any order.

    ``output="blob"``: one row per announced flow with ``content``, ``size``, ``attributes``, ``outcome``,
    ``reason`` and ``length_ok``. A flow whose pieces have more than ``max_blob_bytes`` together does not fit one cell and
    is reported as ``oversize``; what is beyond is not gathered.

    ``output="chunks"``: the pieces of every complete flow of any size, one row per (flow, counter), never
    concatenated. :func:`reassemble_parts` gives flows of any size with their outcomes.
    """
    if output == "chunks":
        return _complete_pieces(datagrams, key, profile)
    if output != "blob":
        raise ValueError(f"output must be 'blob' or 'chunks', got {output!r}")
    max_pieces = max(1024, max_blob_bytes // 16)
    extra = 0 if datagram_profile(profile).announces_first else 1

    pieces = dedupe_datagrams(_pieces(datagrams), key)
    announcement = F.when(F.col("counter") == 0, F.struct("n_datagrams", "payload_length", "header"))
    # Where a piece ends if none before it is lost. Rows lie as the aggregation below wants them: one shuffle serves both.
    in_order = Window.partitionBy(*key).orderBy("counter").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = (F.col("counter") < max_pieces) & (F.col("end") <= max_blob_bytes)
    flows = (
        pieces.withColumn("end", F.sum(F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint")).over(in_order))
        .withColumn("a", announcement)
        .withColumn("place", F.when(kept, F.struct("counter", F.octet_length("payload").alias("len"))))
        .withColumn("left_out", F.when(~kept, F.col("counter")))
        .withColumn("payload", F.when(kept, F.col("payload")))
        .groupBy(*key)
        .agg(
            F.first("a", ignorenulls=True).alias("a"),
            F.count("*").alias("pieces"),
            F.max("counter").alias("last"),
            F.min("left_out").alias("left_out"),
            F.collect_list("place").alias("places"),
            F.expr("listagg(payload) within group (order by counter)").alias("body"),
        )
        .filter(F.col("a").isNotNull())
        .select(*key, (F.col("a.n_datagrams") + extra).cast("bigint").alias("n"), "a.payload_length", "a.header",
                "pieces", "last", "left_out", "places", "body")
    )
    # Pieces numbered n or more are strays of another flow: they sort last, so the content is a prefix of the body.
    strays = F.col("last") >= F.col("n")
    own = F.filter("places", lambda p: p["counter"] < F.col("n"))
    own_bytes = F.aggregate(own, F.lit(0).cast("bigint"), lambda total, p: total + p["len"])
    flows = (
        flows.withColumn("own", F.when(strays, F.size(own)).otherwise(F.col("pieces")))
        .withColumn(
            "content",
            F.when(strays, binary.slice_bytes(F.col("body"), F.lit(0), own_bytes)).otherwise(F.coalesce("body", F.unhex(F.lit("")))),
        )
        .withColumn("attributes", headers.header_attributes(F.col("header")))
    )
    left_out = F.coalesce(F.col("left_out") < F.col("n"), F.lit(False))
    oversize = left_out | (F.col("n") > max_pieces) | (F.octet_length("content") > max_blob_bytes)
    judged = flows.select("*", *_verdict(F.col("own") == F.col("n"), oversize=oversize))
    good = F.col("outcome") == SUCCESS
    size = F.octet_length("content").cast("bigint")
    return judged.select(
        *key,
        F.when(good, F.col("attributes")).alias("attributes"),
        F.when(good, F.col("content")).alias("content"),
        F.when(good, size).alias("size"),
        "outcome",
        "reason",
        F.when(good, size == F.col("payload_length")).alias("length_ok"),
    )


def reassemble_parts(
    datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, profile: str = "v0", part_pieces: int = 2048
) -> DataFrame:
    """O19 for flows of any size: the content as parts of ``part_pieces`` pieces each.

    One row per part of every complete flow, with ``part_no``, ``offset`` and ``content``; an incomplete or unreadable
    flow is one error row with part 0 and no content. ``attributes`` are on part 0; ``size``, ``outcome``, ``reason`` and
    ``length_ok`` are the flow's. Payloads are only ever grouped and joined by part; what is counted per flow is one row
    per part. Of copies with the same ``arrival_seq`` one is taken by the hash of its payload.
    """
    if part_pieces <= 0:
        raise ValueError("part_pieces must be positive")
    part_key = [*key, "part_no"]
    pieces = _pieces(datagrams).select(
        *key,
        "counter",
        counter_block(size=part_pieces).alias("part_no"),
        "payload",
        F.struct(_arrival_order(datagrams).alias("seq"), F.xxhash64("payload").alias("tie")).alias("came"),
    )
    last_copy = Window.partitionBy(*part_key, "counter").orderBy(F.col("came").desc())
    bodies = (
        pieces.withColumn("_copy", F.row_number().over(last_copy))
        .filter("_copy = 1")
        .groupBy(*part_key)
        .agg(F.expr("listagg(payload) within group (order by counter)").alias("body"))
    )

    # The same without payloads: how many pieces of each part are the flow's own, and their bytes.
    length = F.octet_length("payload").cast("bigint")
    lengths = pieces.groupBy(*part_key, "counter").agg(F.max_by(length, F.col("came")).alias("len"))
    places = lengths.groupBy(*part_key).agg(F.collect_list(F.struct("counter", "len")).alias("places"))
    announced = announcements(datagrams, key, profile)
    own = F.filter("places", lambda p: p["counter"] < F.col("n"))
    counted = places.join(announced.select(*key, "n"), list(key)).select(
        *part_key,
        F.size(own).alias("own"),
        F.aggregate(own, F.lit(0).cast("bigint"), lambda total, p: total + p["len"]).alias("own_bytes"),
    )
    earlier = Window.partitionBy(*key).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("offset", F.coalesce(F.sum("own_bytes").over(earlier), F.lit(0)))
    totals = counted.groupBy(*key).agg(F.sum("own").alias("arrived"), F.sum("own_bytes").alias("size"))

    flows = announced.join(totals, list(key), "left").withColumn("attributes", headers.header_attributes(F.col("header")))
    flows = flows.select("*", *_verdict(F.coalesce("arrived", F.lit(0)) == F.col("n")))
    good = F.col("outcome") == SUCCESS
    last_part = F.call_function("div", F.greatest(F.col("n"), F.lit(1)) - 1, F.lit(part_pieces).cast("bigint"))
    parts = F.sequence(F.lit(0).cast("bigint"), F.when(good, last_part).otherwise(F.lit(0).cast("bigint")))
    size = F.coalesce("size", F.lit(0))
    wanted = flows.select(
        *key,
        F.explode(parts).alias("part_no"),
        F.when(good, F.col("attributes")).alias("attributes"),
        F.when(good, size).alias("size"),
        "outcome",
        "reason",
        F.when(good, size == F.col("payload_length")).alias("length_ok"),
    )
    # A part that also has strays ends with them.
    content = binary.slice_bytes(F.coalesce("body", F.unhex(F.lit(""))), F.lit(0), F.coalesce("own_bytes", F.lit(0)))
    return (
        wanted.join(placed, part_key, "left")
        .join(bodies, part_key, "left")
        .select(
            *part_key,
            F.when(good, F.coalesce("offset", F.lit(0))).alias("offset"),
            F.when(good, content).alias("content"),
            F.when(F.col("part_no") == 0, F.col("attributes")).alias("attributes"),
            "size",
            "outcome",
            "reason",
            "length_ok",
        )
    )


def _complete_pieces(datagrams: DataFrame, key: Sequence[str], profile: str) -> DataFrame:
    # Joined by block of counters, so that no flow is one key for all its payloads.
    blocks = F.sequence(F.lit(0).cast("bigint"), counter_block(F.greatest(F.col("n"), F.lit(1)) - 1))
    status = flow_status(datagrams, key, profile).filter(F.col("outcome") == SUCCESS)
    status = status.select(*key, "n", "attributes", F.explode(blocks).alias("_block"))
    pieces = dedupe_datagrams(_pieces(datagrams).select(*key, "counter", "payload", _arrival_order(datagrams).alias("arrival_seq")), key)
    return (
        pieces.withColumn("_block", counter_block()).join(status, [*key, "_block"])
        .filter(F.col("counter") < F.col("n"))
        .select(*key, "counter", "payload", F.when(F.col("counter") == 0, F.col("attributes")).alias("attributes"))
    )


# --- what is missing ---------------------------------------------------------------------------


def missing_datagrams(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, profile: str = "v0") -> DataFrame:
    """O17. The counters of each announced flow that never arrived."""
    expected = announcements(datagrams, key, profile).filter(F.col("n") > 0)
    last_block = F.floor((F.col("n") - 1) / F.lit(COUNTER_BLOCK))
    blocks = expected.select(*key, "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block)).alias("block"))
    arrived = blocks.join(counter_blocks(datagrams, key), [*key, "block"], "left")
    base = F.col("block") * COUNTER_BLOCK
    wanted = F.sequence(base, F.least(base + COUNTER_BLOCK, F.col("n")) - 1)
    absent = F.array_except(wanted, F.coalesce("counters", F.array().cast("array<bigint>")))
    return arrived.select(*key, F.explode(absent).alias("counter"))


def orphan_datagrams(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """O18. Distinct data pieces of flows that were never announced."""
    announced = datagrams.filter(F.col("header_type") == 0).select(*key).distinct()
    data = datagrams.filter(F.col("header_type") == 1)
    blocks = counter_blocks(data, key).join(announced, list(key), "left_anti")
    return blocks.select(*key, F.explode("counters").alias("counter"))


# --- ordered progress --------------------------------------------------------------------------


def contiguous_prefix(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY) -> DataFrame:
    """O25. ``right_boundary``: the highest r with pieces 0..r all there, -1 if piece 0 is missing."""
    base = F.col("block") * COUNTER_BLOCK
    blocks = counter_blocks(datagrams, key).select(
        *key,
        "block",
        F.size("counters").alias("count"),
        F.size(F.filter("counters", lambda c, i: c == F.col("block") * COUNTER_BLOCK + i)).alias("lead"),
    )
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.sum("count").over(earlier), F.lit(0)) == base
    boundary = F.max(F.when(F.col("reached") & (F.col("lead") > 0), base + F.col("lead") - 1))
    return (
        blocks.withColumn("reached", reached)
        .groupBy(*key)
        .agg(F.coalesce(boundary, F.lit(-1)).cast("bigint").alias("right_boundary"))
    )


def first_arrivals(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, at: str = "arrival_ts") -> DataFrame:
    """When each piece first came, in ms. Repeats are merged before the shuffle."""
    timed = _pieces(datagrams.withColumn("_ms", epoch_millis(datagrams, at)))
    return timed.groupBy(*key, "counter").agg(F.min("_ms").alias("first_ms"))


def prefix_progress(datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, at: str = "arrival_ts") -> DataFrame:
    """O26. When each piece of the contiguous prefix became usable: the latest first arrival among 0..counter."""
    first = first_arrivals(datagrams, key, at).withColumn("block", counter_block())
    return contiguous_arrivals(first, key).select(*key, "counter", "usable_ms")


def contiguous_arrivals(first: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``first`` (one per piece, with its ``block``) before the first gap, with ``usable_ms``."""
    values = {"rank": ("sum", F.lit(1)), "usable_ms": ("max", F.col("first_ms"))}
    ranked = running(first, key, F.col("block"), ["counter"], values)
    return ranked.filter(F.col("counter") == F.col("rank") - 1).drop("rank")


# --- statistics and pacing ---------------------------------------------------------------------


def _data_bytes(profile: str) -> Column:
    """Payload bytes, plus the data header on every datagram but the first."""
    header = F.when(F.col("header_type") == 1, datagram_profile(profile).data_header).otherwise(0)
    return F.octet_length("payload") + header


def transfer_stats(
    datagrams: DataFrame, key: Sequence[str] = FLOW_KEY, at: str = "arrival_ts", profile: str = "v0"
) -> DataFrame:
    """O20. Per flow: datagrams, bytes, elapsed seconds, packets per second, Mbit per second (null if no time passed).

    Keepalives and packets of unknown types are no datagrams of a flow.
    """
    ms = epoch_millis(datagrams, at)
    sums = _pieces(datagrams).groupBy(*key).agg(
        F.count("*").alias("datagrams"),
        F.sum(_data_bytes(profile)).alias("bytes"),
        ((F.max(ms) - F.min(ms)) / 1000.0).alias("elapsed_s"),
    )
    seconds = F.when(F.col("elapsed_s") > 0, F.col("elapsed_s"))
    return sums.withColumn("pps", F.col("datagrams") / seconds).withColumn(
        "mbit", F.col("bytes") * 8 / seconds / 1_000_000
    )


def receiver_totals(datagrams: DataFrame, by: str = "source", at: str = "arrival_ts", subtotals: bool = False) -> DataFrame:
    """O21. Per receiver or sender: datagrams, first and last arrival, running time; with ``subtotals`` also per
    flow and overall (``rollup``)."""
    timed = datagrams.withColumn("_ms", epoch_millis(datagrams, at))
    grouped = timed.rollup(by, "flow_id") if subtotals else timed.groupBy(by)
    return grouped.agg(
        F.count("*").alias("datagrams"),
        F.min("_ms").alias("first_ms"),
        F.max("_ms").alias("last_ms"),
        (F.max("_ms") - F.min("_ms")).alias("running_ms"),
    )


def pacing_schedule(datagrams: DataFrame, max_pps: int) -> DataFrame:
    """O28. Earliest send offset of each datagram when at most ``max_pps`` datagrams may go per second.

    The first two leave at once; piece j waits until ``j / max_pps`` seconds have passed.
    """
    if max_pps <= 0:
        raise ValueError("max_pps must be positive")
    offset = F.when(F.col("counter") <= 1, 0.0).otherwise(F.col("counter") * 1000.0 / max_pps)
    return datagrams.withColumn("send_ms", offset)
