"""Flows as framed, raw or delimited byte streams, and back.

A frame is ``[int32 version (profiles v0, legacy)] [int32 header length] [int64 payload length] [header] [payload]``,
big-endian. Frames lie end to end on a connection, whose bytes arrive as numbered segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions import binary, headers
from flowtables.operators.attributes import encode_attributes
from flowtables.operators.framecutter import FrameCutter, few_bytes, piece_batch
from flowtables.operators.hot_connections import MAX_HEADER_BYTES, cut_blocks
from flowtables.operators.ordered import RANGE_BLOCK, counter_block, range_blocks, running
from flowtables.schema import ERROR, FRAME_VERSIONS, MAX_BLOB_BYTES, SUCCESS, frame_prefix_bytes


# A connection longer than this is not read by one task alone.
HOT_BYTES = 1 << 30
HOT_BLOCK_BYTES = 4 << 20


def _no_bytes() -> Column:
    return F.unhex(F.lit(""))


# --- sending -----------------------------------------------------------------------------------


def frame_bytes(flows: DataFrame, profile: str = "v2", mode: str = "flow_and_attributes") -> DataFrame:
    """Add ``frame``, the flow as it goes over a connection, and ``frame_len``; ``mode="flow_only"`` is the bare content.

    The length comes from ``size``, so it can be had without reading contents.
    """
    prefix = frame_prefix_bytes(profile)
    if mode == "flow_only":
        return flows.withColumn("frame", F.col("content")).withColumn("frame_len", F.col("size"))
    if mode != "flow_and_attributes":
        raise ValueError(f"unknown mode {mode!r}")
    version = FRAME_VERSIONS[profile]
    header = binary.utf8_bytes(F.coalesce("header_json", F.lit("")))
    parts = [] if version is None else [binary.int32_bytes(F.lit(version))]
    parts += [binary.int32_bytes(F.col("header_len")), binary.int64_bytes(F.col("size")), header, F.col("content")]
    return encode_attributes(flows, typed=profile == "legacy").withColumns(
        {"frame": F.concat(*parts), "frame_len": F.lit(prefix) + F.col("header_len") + F.col("size")}
    )


def flows_to_segments(
    flows: DataFrame,
    conn: str = "conn_id",
    order: str = "flow_id",
    profile: str = "v2",
    mode: str = "flow_and_attributes",
    segment_bytes: int = 65536,
    order_block: int | None = 1024,
) -> DataFrame:
    """O2. Lay flows end to end on their connection in ``order`` (a number) and cut the bytes into segments.

    Returns ``conn, seq, offset, bytes``. ``order_block`` is the stretch of order numbers placed in one task. With None,
    flows are placed in measured ranges (``range_blocks``, without contents): order numbers may then be hashes.
    """
    if segment_bytes <= 0:
        raise ValueError("segment_bytes must be positive")
    framed = frame_bytes(flows, profile, mode).select(conn, order, "frame", "frame_len")
    length = {"end": ("sum", F.col("frame_len"))}
    if order_block is None:
        # Only numbers and lengths are dealt by range; frames join what comes of them.
        light = range_blocks(framed.select(conn, order, "frame_len"), [conn], [order])
        ends = running(light, [conn], F.col(RANGE_BLOCK), [order], length).select(conn, order, "end")
        placed = framed.join(ends, [conn, order])
    else:
        placed = running(framed, [conn], counter_block(order, order_block), [order], length)
    placed = placed.withColumn("start", F.col("end") - F.col("frame_len"))
    first, last = (F.floor(c / F.lit(segment_bytes)).cast("bigint") for c in (F.col("start"), F.col("end") - 1))
    cut_from = F.greatest(F.col("start"), F.col("seq") * segment_bytes)
    cut_to = F.least(F.col("end"), (F.col("seq") + 1) * segment_bytes)
    return (
        placed.filter(F.col("end") > F.col("start"))
        .select(conn, "frame", "start", "end", F.explode(F.sequence(first, last)).alias("seq"))
        .select(conn, "seq", "start", binary.slice_bytes(F.col("frame"), cut_from - F.col("start"), cut_to - cut_from).alias("part"))
        .groupBy(conn, "seq")
        .agg(F.expr("listagg(part) within group (order by start)").alias("bytes"))
        .select(conn, "seq", (F.col("seq") * segment_bytes).alias("offset"), "bytes")
    )


# --- framed streams ----------------------------------------------------------------------------


def cut_frames(
    segments: DataFrame,
    conn: str = "conn_id",
    seq: str = "seq",
    profile: str = "v2",
    hot_bytes: int = HOT_BYTES,
    block_bytes: int = HOT_BLOCK_BYTES,
    max_blob_bytes: int | None = None,
) -> DataFrame:
    """The pieces of every frame (see :class:`FrameCutter`).

    Most connections are read front to back in one task each, with flat memory. Those of more than ``hot_bytes``
    are cut into blocks that are read side by side; see ``hot_connections``.
    """
    if "offset" in segments.columns:  # no other column is read for this
        hot = segments.filter(F.col("offset") >= hot_bytes).select(conn).distinct()
    else:
        sizes = segments.groupBy(conn).agg(F.sum(F.octet_length("bytes").cast("bigint")).alias("size"))
        hot = sizes.filter(F.col("size") > hot_bytes).select(conn)
    # At most one connection per hot_bytes of input: the list is short whatever the input, so no bytes are shuffled for it.
    hot = F.broadcast(hot)
    blocks = byte_blocks(
        segments.join(hot, conn, "left_semi"), conn, seq, block_bytes, after=frame_prefix_bytes(profile) - 1
    )
    side_by_side, unresolved = cut_blocks(blocks, conn, frame_prefix_bytes(profile), block_bytes, max_blob_bytes)
    in_turn = segments.join(hot, conn, "left_anti").unionByName(segments.join(F.broadcast(unresolved), conn, "left_semi"))
    # By a hash of the connection: a repartition by the connection itself is left out by Spark where a join below has dealt the
    # rows so, and when that join turns into a broadcast, each task reads what one task wrote, of many connections a part.
    dealt = in_turn.select(conn, "bytes", seq).repartition(F.xxhash64(conn))
    return _cut_in_turn(dealt, conn, seq, profile).unionByName(side_by_side)


def _cut_in_turn(segments: DataFrame, conn: str, seq: str, profile: str) -> DataFrame:
    """The pieces of segments of which each connection's lie in one partition."""
    prefix = frame_prefix_bytes(profile)
    conn_type = segments.schema[conn].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cutter = None, None
        for batch in few_bytes(batches):
            names, rows = [], []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if cutter is None or name != current:
                    current, cutter = name, FrameCutter(prefix)
                pieces = cutter.feed(data or b"")
                names += [name] * len(pieces)
                rows += pieces
            yield piece_batch(names, rows, conn, batch.schema.field(0).type)

    ordered = segments.select(conn, "bytes", seq).sortWithinPartitions(conn, seq)
    return ordered.select(conn, "bytes").mapInArrow(cut, f"`{conn}` {conn_type}, {FrameCutter.SCHEMA}")


def assemble_frames(
    pieces: DataFrame,
    conn: str = "conn_id",
    on_truncated: str = SUCCESS,
    output: str = "blob",
    max_blob_bytes: int = MAX_BLOB_BYTES,
) -> DataFrame:
    """Flows from the pieces of :func:`cut_frames`; see :func:`segments_to_flows`."""
    if on_truncated not in (SUCCESS, ERROR):
        raise ValueError(f"on_truncated must be {SUCCESS!r} or {ERROR!r}")
    if output not in ("blob", "chunks"):
        raise ValueError(f"output must be 'blob' or 'chunks', got {output!r}")
    key = [conn, "frame_no"]
    header_len, payload_len = F.col("header_len"), F.col("payload_len")
    fits = F.coalesce(payload_len <= max_blob_bytes, F.lit(True)) if output == "blob" else F.lit(False)
    # Frames that stay in pieces are judged by their header; a piece that does not know its length is kept if unsure.
    in_header = F.col("at") < F.coalesce(header_len, F.lit(MAX_HEADER_BYTES))
    announced = F.col("part") != "D"
    frames = pieces.withColumn("body", F.when(fits | in_header, F.col("bytes"))).groupBy(*key).agg(
        F.max(F.when(announced, header_len)).alias("header_len"),
        F.max(F.when(announced, payload_len)).alias("payload_len"),
        F.max(F.col("part") == "X").alias("bad"),
        F.coalesce(F.sum(F.octet_length("bytes").cast("bigint")), F.lit(0)).alias("got"),
        F.expr("listagg(body) within group (order by at)").alias("body"),
    )
    body, header_bytes = F.coalesce("body", _no_bytes()), F.coalesce(header_len, F.lit(0))
    frames = frames.withColumns(
        {
            "whole": F.coalesce((F.col("got") == header_len + payload_len) & ~F.col("bad"), F.lit(False)),
            "size": F.greatest(F.col("got") - header_bytes, F.lit(0)),
        }
    )
    # What a closing connection leaves open: the first frame always, a later one once payload has come.
    frames = frames.filter(F.col("whole") | F.col("bad") | (F.col("frame_no") == 0) | (F.col("size") > 0))
    header = F.decode(binary.slice_bytes(body, F.lit(0), header_bytes), "UTF-8")
    has_header = F.col("whole") & (header_len > 0)
    frames = frames.withColumns(
        {
            "truncated": ~F.col("whole") & ~F.col("bad"),
            "decoded": F.when(has_header, headers.header_attributes(header)),
        }
    )
    reason = F.when(F.col("bad"), "bad_length").when(has_header & F.col("decoded").isNull(), "bad_header")
    if output == "blob":
        reason = reason.when(payload_len > max_blob_bytes, "oversize")
    if on_truncated == ERROR:
        reason = reason.when(F.col("truncated"), "truncated")
    frames = frames.withColumn("reason", reason)
    good = F.col("reason").isNull()
    verdict = [F.when(good, SUCCESS).otherwise(ERROR).alias("outcome"), F.col("reason"), F.col("truncated")]
    attributes = F.when(good, F.col("decoded")).alias("attributes")
    if output == "blob":
        content = binary.slice_bytes(body, header_bytes, F.col("size"))
        return frames.select(
            *key, attributes, F.when(good, content).alias("content"), F.when(good, F.col("size")).alias("size"), *verdict
        )
    # Joined by stretch of the frame, so that no frame is one key for all its bytes.
    def stretch(at: Column) -> Column:
        return F.call_function("div", at, F.lit(HOT_BLOCK_BYTES).cast("bigint"))

    stretches = F.sequence(F.lit(0).cast("bigint"), stretch(F.col("got")))
    judged = frames.select(*key, attributes, header_bytes.alias("_header"), *verdict, F.explode(stretches).alias("_stretch"))
    skipped = F.greatest(F.col("_header") - F.col("at"), F.lit(0))
    return (
        pieces.filter(F.col("part") == "D")
        .select(*key, stretch(F.col("at")).alias("_stretch"), "at", "bytes")
        .join(judged, [*key, "_stretch"])
        .filter(F.octet_length("bytes") > skipped)
        .select(
            *key,
            (F.col("at") + skipped - F.col("_header")).alias("offset"),
            binary.slice_bytes(F.col("bytes"), skipped, F.octet_length("bytes") - skipped).alias("bytes"),
            "attributes",
            "outcome",
            "reason",
            "truncated",
        )
    )


def segments_to_flows(
    segments: DataFrame,
    conn: str = "conn_id",
    seq: str = "seq",
    profile: str = "v2",
    on_truncated: str = SUCCESS,
    output: str = "blob",
    max_blob_bytes: int = MAX_BLOB_BYTES,
    hot_bytes: int = HOT_BYTES,
    block_bytes: int = HOT_BLOCK_BYTES,
) -> DataFrame:
    """O3. Recover every flow of every framed connection.

    A connection that closes inside a flow leaves a ``truncated`` flow without attributes, which counts as
    success or error by ``on_truncated``. A header that is no JSON object makes an error row; a negative length
    makes one too and ends its connection. A payload beyond ``max_blob_bytes`` is reported as ``oversize``;
    ``output="chunks"`` gives the pieces of payloads of any size instead, by their ``offset`` in the payload.
    """
    blob = max_blob_bytes if output == "blob" else None
    pieces = cut_frames(segments, conn, seq, profile, hot_bytes, block_bytes, blob)
    return assemble_frames(pieces, conn, on_truncated, output, max_blob_bytes)


# --- raw streams -------------------------------------------------------------------------------


def segment_offsets(segments: DataFrame, conn: str = "conn_id", seq: str = "seq", order_block: int = 1024) -> DataFrame:
    """Add ``offset``, the place of each segment's first byte on its connection."""
    if "offset" in segments.columns:
        return segments
    length = F.octet_length("bytes").cast("bigint")
    return running(
        segments, [conn], counter_block(seq, order_block), [seq], {"_end": ("sum", length)}
    ).withColumn("offset", F.col("_end") - length).drop("_end")


def raw_streams_to_flows(
    segments: DataFrame,
    conn: str = "conn_id",
    seq: str = "seq",
    output: str = "blob",
    max_blob_bytes: int = MAX_BLOB_BYTES,
    part_bytes: int = HOT_BLOCK_BYTES,
) -> DataFrame:
    """O4. All bytes of a connection, in order, are one flow without attributes.

    Connections longer than ``max_blob_bytes`` are reported as ``oversize`` and never gathered.
    ``output="parts"`` gives connections of any length as ``part_no, offset, content``, every part but the last of
    ``part_bytes``; a connection without bytes has none. ``output="chunks"`` places the segments by ``offset`` instead.
    """
    if output == "parts":
        parts = byte_blocks(segments, conn, seq, part_bytes)
        return parts.select(
            conn, F.col("block").alias("part_no"), F.col("start").alias("offset"), F.col("bytes").alias("content")
        )
    if output == "chunks":
        return segment_offsets(segments.select(conn, seq, "bytes"), conn, seq)
    if output != "blob":
        raise ValueError(f"output must be 'blob', 'parts' or 'chunks', got {output!r}")
    sizes = segments.groupBy(conn).agg(F.sum(F.octet_length("bytes").cast("bigint")).alias("size"))
    oversize = sizes.filter(F.col("size") > max_blob_bytes)
    whole = (
        segments.select(conn, seq, "bytes")
        .join(oversize.select(conn), conn, "left_anti")
        .groupBy(conn)
        .agg(F.expr(f"listagg(bytes) within group (order by `{seq}`)").alias("content"))
        .select(
            conn,
            F.coalesce("content", _no_bytes()).alias("content"),
            F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint").alias("size"),
            F.lit(SUCCESS).alias("outcome"),
            F.lit(None).cast("string").alias("reason"),
        )
    )
    refused = oversize.select(
        conn, F.lit(None).cast("binary").alias("content"), "size", F.lit(ERROR).alias("outcome"), F.lit("oversize").alias("reason")
    )
    return whole.unionByName(refused)


# --- delimited streams -------------------------------------------------------------------------


def byte_blocks(
    segments: DataFrame, conn: str, seq: str, size: int, before: int = 0, after: int = 0
) -> DataFrame:
    """Each connection re-cut into blocks of ``size`` bytes, with some bytes of the neighbouring blocks around.

    Returns ``conn, block, start, bytes``; ``start`` is the offset of the first byte given.
    """
    placed = segment_offsets(segments.select(*dict.fromkeys([conn, seq, *(c for c in segments.columns if c == "offset"), "bytes"])), conn, seq)
    offset, end = F.col("offset"), F.col("offset") + F.octet_length("bytes")
    first = F.greatest(F.floor((offset - after) / F.lit(size)), F.lit(0)).cast("bigint")
    last = (F.ceil((end + before) / F.lit(size)) - 1).cast("bigint")
    block_from = F.col("block") * size
    cut_from = F.greatest(offset, block_from - before)
    cut_to = F.least(F.col("end"), block_from + size + after)
    inside = (F.col("offset") < block_from + size) & (F.col("end") > block_from)
    return (
        placed.filter(F.octet_length("bytes") > 0)
        .select(conn, "offset", end.alias("end"), "bytes", F.explode(F.sequence(first, last)).alias("block"))
        .select(
            conn, "block", cut_from.alias("at"), inside.alias("inside"),
            binary.slice_bytes(F.col("bytes"), cut_from - offset, cut_to - cut_from).alias("part"),
        )
        .groupBy(conn, "block")
        .agg(
            F.min("at").alias("start"),
            F.max("inside").alias("inside"),
            F.expr("listagg(part) within group (order by at)").alias("bytes"),
        )
        .filter("inside")
        .drop("inside")
    )


def _overlaps_itself(delimiter: bytes) -> bool:
    return any(delimiter[i:] == delimiter[: len(delimiter) - i] for i in range(1, len(delimiter)))


def _split(data: Column, delimiter: bytes) -> Column:
    """Array of strings, one character per byte."""
    text = delimiter.decode("latin-1").replace("\\E", "\\E\\\\E\\Q")
    return F.split(F.decode(data, "ISO-8859-1"), rf"\Q{text}\E", -1)


def delimited_streams_to_flows(
    segments: DataFrame, delimiter: bytes = b"\n", conn: str = "conn_id", seq: str = "seq", block_bytes: int = 1 << 20
) -> DataFrame:
    """O5. Split each connection's bytes at a delimiter of one or more bytes; a non-empty tail is a last message.

    Returns ``conn, msg_no, content``. A connection is split block by block. With a delimiter that can overlap itself
    (like two line feeds) a block must know how much of it the last delimiter before has taken; see :func:`_entered`.
    """
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    edge = len(delimiter) - 1
    block_bytes = max(block_bytes, len(delimiter))
    if _overlaps_itself(delimiter):
        blocks = _entered(byte_blocks(segments, conn, seq, block_bytes, 0, edge), delimiter, conn, block_bytes)
    else:
        blocks = byte_blocks(segments, conn, seq, block_bytes, edge, edge)
    tokens = blocks.select(
        conn, "block", "start", F.posexplode(_split(F.col("bytes"), delimiter)).alias("i", "text")
    )
    cells = [conn, "block"]
    in_order = Window.partitionBy(*cells).orderBy("i")
    preceding = F.coalesce(
        F.sum(F.length("text").cast("bigint")).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    begin = F.col("start") + preceding + F.col("i") * len(delimiter)
    block_from, block_to = F.col("block") * block_bytes, (F.col("block") + 1) * block_bytes
    tokens = tokens.withColumn("begin", begin).withColumn("end", F.col("begin") + F.length("text"))
    # The delimiter in front of token i ends a message; it counts for the block it starts in.
    mark = F.col("begin") - len(delimiter)
    tokens = tokens.withColumn("mark", ((F.col("i") > 0) & (mark >= block_from) & (mark < block_to)).cast("bigint"))
    cut_from, cut_to = F.greatest("begin", block_from), F.least("end", block_to)
    text = F.substring("text", (cut_from - F.col("begin") + 1).cast("int"), (cut_to - cut_from).cast("int"))
    own = F.when(
        cut_to > cut_from,
        F.struct(F.col("msg_no"), cut_from.alias("at"), F.encode(text, "ISO-8859-1").alias("part")),
    )
    ended = F.when(
        F.col("mark") == 1, F.struct((F.col("msg_no") - 1).alias("msg_no"), mark.alias("at"), _no_bytes().alias("part"))
    )
    return (
        running(tokens, [conn], F.col("block"), ["i"], {"msg_no": ("sum", F.col("mark"))})
        .select(conn, F.explode(F.array_compact(F.array(own, ended))).alias("p"))
        .select(conn, "p.*")
        .groupBy(conn, "msg_no")
        .agg(F.expr("listagg(part) within group (order by at)").alias("content"))
    )


def _entered(blocks: DataFrame, delimiter: bytes, conn: str, block_bytes: int) -> DataFrame:
    """``blocks`` less the bytes at their beginning that belong to a delimiter of the block before.

    Each block works out what it would take of the next one for every number of bytes taken from itself, at most a
    delimiter's length of cases. These few numbers a block are followed along the connection.
    """

    def taken_of_next(taken: int) -> Column:
        rest = F.element_at(_split(binary.slice_bytes(F.col("bytes"), F.lit(taken), F.octet_length("bytes")), delimiter), -1)
        return F.greatest(F.octet_length("bytes") - F.length(rest) - block_bytes, F.lit(0))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, entry = None, None
        for batch in batches:
            entries = []
            for name, case in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if entry is None or name != current:
                    current, entry = name, 0
                entries.append(entry)
                entry = case[entry]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(entries, pa.int32())], names=[conn, "block", "entry"]
            )

    cases = blocks.select(conn, "block", F.array(*(taken_of_next(r) for r in range(len(delimiter)))).alias("cases"))
    conn_type = blocks.schema[conn].dataType.simpleString()
    # Many short connections go through a task one after the other, without a call for each.
    in_order = cases.repartition(conn).sortWithinPartitions(conn, "block")
    entries = in_order.mapInArrow(follow, f"`{conn}` {conn_type}, block long, entry int")
    entry = F.col("entry")
    return blocks.join(entries, [conn, "block"]).select(
        conn,
        "block",
        (F.col("start") + entry).alias("start"),
        binary.slice_bytes(F.col("bytes"), entry, F.octet_length("bytes")).alias("bytes"),
    )
