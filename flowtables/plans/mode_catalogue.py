"""Registered queries of the operators' other modes: layouts, outputs, older rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.functions import binary
from flowtables.operators import attributes as attrs
from flowtables.operators import datagrams as dg
from flowtables.operators import framed, network, outcomes
from flowtables.plans import views
from flowtables.plans.catalogue import FRAMES_SQL, flow_report, frame_report, query
from flowtables.plans.views_sql import ARRIVALS, DATAGRAMS, EVENT_IP, FLOWS, FRAMES, SHORT_FLOWS, with_views
from flowtables.schema import ERROR, SUCCESS
from flowtables.sources.flows import read_flows as read_files
from flowtables.sources.workdir import work_dir

PART_PIECES = 8
PART_BYTES = 256
MAX_PACKET = 400
FILE_DOCUMENTS = 100

# --- files and attributes --------------------------------------------------------------------------------


@query(
    f"""SELECT doc_id // {FILE_DOCUMENTS} AS bucket, CAST(sum(strlen(text) + 1) AS BIGINT) AS size,
          md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS content_md5 FROM documents GROUP BY 1"""
)
def read_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a hundred documents each, read back as flows."""
    path = work_dir(spark, "files")
    bucket = F.call_function("div", F.col("doc_id"), F.lit(FILE_DOCUMENTS)).alias("bucket")
    documents = views.table(spark, sf_dir, "documents").select(bucket, "doc_id", "text")
    files = documents.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
    files.select("bucket", "text").write.partitionBy("bucket").text(path)
    found = F.regexp_extract(F.col("attributes.path"), r"bucket=(\d+)/$", 1).cast("bigint")
    return read_files(spark, path, glob="*.txt").select(
        found.alias("bucket"), "size", F.md5("content").alias("content_md5")
    )


@query(
    with_views(
        FLOWS,
        """SELECT flow_id, k AS key, list_filter(entries, lambda e: e.k = names.k)[1].v AS value
           FROM flows, (VALUES ('absent'), ('lang'), ('note'), ('priority')) AS names(k)""",
    )
)
def select_list_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = attrs.select_attributes(views.flows(spark, sf_dir), names=views.LISTED, null_for_missing=True)
    return attrs.attributes_long(chosen)


@query("SELECT doc_id AS flow_id, CAST(0 AS BIGINT) AS header_len, true AS bare FROM documents")
def select_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = attrs.encode_attributes(attrs.select_attributes(views.flows(spark, sf_dir), include_attributes=False))
    return bare.select(
        "flow_id", F.col("header_len").cast("bigint").alias("header_len"), F.col("header_json").isNull().alias("bare")
    )


@query(
    with_views(
        FLOWS,
        """SELECT flow_id, replace(header, ',"uuid"', ',"tcp.receiver":"127.0.0.1","tcp.receiver_port":"6666","tcp.sender":"127.0.0.2","uuid"')
             AS header_json FROM flows""",
    )
)
def endpoint_attributes_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = views.sent_flows(spark, sf_dir)
    with_ends = attrs.add_endpoint_attributes(flows, F.col("source"), "127.0.0.1", 6666, "127.0.0.2", compat=True)
    return attrs.encode_attributes(with_ends).select("flow_id", "header_json")


# --- streams of bytes --------------------------------------------------------------------------


@query(
    with_views(
        FRAMES,
        """SELECT conn_id, frame_no, size, md5(text) AS content_md5, header AS header_json, 'success' AS outcome FROM frames""",
    )
)
def framed_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = framed.flows_to_segments(
        views.connected_flows(spark, sf_dir), profile="v0", segment_bytes=views.SEGMENT_BYTES
    )
    frames = attrs.encode_attributes(framed.segments_to_flows(segments, profile="v0"))
    return frames.select("conn_id", "frame_no", "size", F.md5("content").alias("content_md5"), "header_json", "outcome")


@query(FRAMES_SQL)
def framed_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = framed.flows_to_segments(
        views.connected_flows(spark, sf_dir), profile="legacy", segment_bytes=views.SEGMENT_BYTES
    )
    return frame_report(framed.segments_to_flows(segments, profile="legacy"))


@query(
    with_views(
        FLOWS,
        """SELECT flow_id % 50 AS conn_id, CAST(sum(size) AS BIGINT) AS size,
             md5(string_agg(text, '' ORDER BY flow_id)) AS content_md5 FROM flows GROUP BY 1 HAVING sum(size) > 0""",
    )
)
def framed_flow_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = framed.flows_to_segments(
        views.connected_flows(spark, sf_dir), mode="flow_only", segment_bytes=views.SEGMENT_BYTES
    )
    return framed.raw_streams_to_flows(segments).select("conn_id", "size", F.md5("content").alias("content_md5"))


@query(
    with_views(
        FRAMES,
        """, cut AS (
             SELECT *, CASE WHEN conn_id % 10 = 3 THEN total * 9 // 10 ELSE total END AS closed, frame_end - size AS body_start
             FROM placed)
           SELECT conn_id, frame_no, CASE WHEN closed >= frame_end THEN size END AS size,
             CASE WHEN closed >= frame_end THEN md5(text) END AS content_md5,
             CASE WHEN closed >= frame_end THEN 'success' ELSE 'error' END AS outcome, closed < frame_end AS truncated
           FROM cut WHERE closed >= frame_end OR frame_no = 0 OR closed > body_start""",
    )
)
def framed_truncated_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_report(framed.segments_to_flows(views.truncated_segments(spark, sf_dir), on_truncated=ERROR))


@query(with_views(FLOWS, """SELECT flow_id, size, md5(text) AS content_md5, 'success' AS outcome FROM flows"""))
def framed_one_connection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on one connection, read by blocks side by side."""
    flows = views.flows(spark, sf_dir).withColumn("conn_id", F.lit(0))
    segments = framed.flows_to_segments(flows, segment_bytes=16 << 10)
    frames = framed.segments_to_flows(segments, hot_bytes=1 << 16, block_bytes=1 << 18)
    flow_id = F.regexp_extract(F.col("attributes.filename"), r"\d+", 0).cast("bigint")
    return frames.select(flow_id.alias("flow_id"), "size", F.md5("content").alias("content_md5"), "outcome")


@query(with_views(FRAMES, "SELECT conn_id, frame_no, size, md5(text) AS content_md5 FROM frames WHERE size > 0"))
def framed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = framed.segments_to_flows(views.framed_segments(spark, sf_dir), output="chunks")
    return chunks.groupBy("conn_id", "frame_no").agg(
        F.sum(F.octet_length("bytes").cast("bigint")).alias("size"),
        F.expr("md5(listagg(bytes) within group (order by offset))").alias("content_md5"),
    )


@query(
    f"""SELECT conv_id, part_no, part_no * {PART_BYTES} AS "offset",
          md5(unhex(substr(hexed, 2 * {PART_BYTES} * part_no + 1, 2 * {PART_BYTES}))) AS content_md5
        FROM (SELECT conv_id, hexed, unnest(generate_series(0, (strlen(hexed) // 2 - 1) // {PART_BYTES})) AS part_no
              FROM (SELECT conv_id, string_agg(hex(encode(text)), '' ORDER BY turn) AS hexed FROM conversations GROUP BY conv_id)
              WHERE hexed <> '')"""
)
def raw_streams_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = views.raw_segments(spark, sf_dir)
    parts = framed.raw_streams_to_flows(segments, "conv_id", "seq", output="parts", part_bytes=PART_BYTES)
    return parts.select("conv_id", "part_no", "offset", F.md5("content").alias("content_md5"))


@query(
    """SELECT doc_id, i - 1 AS msg_no, strlen(parts[i]) AS len, md5(parts[i]) AS content_md5
       FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
             FROM (SELECT doc_id, string_split(text, '. ') AS parts FROM documents))
       WHERE i < len(parts) OR parts[i] <> ''"""
)
def delimited_by_two_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(0).cast("bigint").alias("seq"), F.encode("text", "UTF-8").alias("bytes")
    )
    messages = framed.delimited_streams_to_flows(segments, b". ", "doc_id", "seq", block_bytes=4096)
    return messages.select(
        "doc_id", "msg_no", F.octet_length("content").cast("bigint").alias("len"), F.md5("content").alias("content_md5")
    )


@query(
    """SELECT doc_id, i - 1 AS msg_no, strlen(parts[i]) AS len, md5(parts[i]) AS content_md5
       FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
             FROM (SELECT doc_id, string_split(text, 'll') AS parts FROM documents))
       WHERE i < len(parts) OR parts[i] <> ''"""
)
def delimited_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimiter that can overlap itself, over several blocks a document."""
    segments = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(0).cast("bigint").alias("seq"), F.encode("text", "UTF-8").alias("bytes")
    )
    messages = framed.delimited_streams_to_flows(segments, b"ll", "doc_id", "seq", block_bytes=1024)
    return messages.select(
        "doc_id", "msg_no", F.octet_length("content").cast("bigint").alias("len"), F.md5("content").alias("content_md5")
    )


# --- datagrams ---------------------------------------------------------------------------------

_LEGACY = (
    SHORT_FLOWS
    + """, cut AS (
      SELECT *, 1426 - strlen(header) AS fill, hex(encode(text)) AS hexed,
        greatest(CAST(ceil((size - (1426 - strlen(header))) / 1450.0) AS BIGINT), 0) AS later FROM flows),
    pieces AS (
      SELECT flow_id, later, counter, size, header, CASE WHEN counter = 0 THEN substr(hexed, 1, 2 * fill)
        ELSE substr(hexed, 2 * (fill + (counter - 1) * 1450) + 1, 2900) END AS piece
      FROM (SELECT *, unnest(generate_series(0, later)) AS counter FROM cut))"""
)


def _packets(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        F.col("flow_id").cast("bigint").alias("flow_id"),
        "counter",
        F.col("n_datagrams").cast("bigint").alias("n_datagrams"),
        "kind",
        "payload_length",
        "header",
        F.md5("payload").alias("md5"),
    )


_PACKETS = """SELECT flow_id, counter, CASE WHEN counter = 0 THEN {n} END AS n_datagrams,
      CASE WHEN counter = 0 THEN 'first' ELSE 'data' END AS kind, CASE WHEN counter = 0 THEN {size} END AS payload_length,
      CASE WHEN counter = 0 THEN header END AS header, md5(unhex(piece)) AS md5 FROM {pieces}"""


@query(with_views(DATAGRAMS, _PACKETS.format(n="n", size="payload_length", pieces="datagrams")))
def packets_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = dg.encode_packets(views.datagrams(spark, sf_dir)).select("source", "packet")
    return _packets(dg.parse_packets(packets))


@query(with_views(_LEGACY, _PACKETS.format(n="later", size="size", pieces="pieces")))
def packets_roundtrip_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = dg.packetize(views.short_flows(spark, sf_dir), profile="legacy")
    packets = dg.encode_packets(sent, "legacy").select("source", "packet")
    return _packets(dg.parse_packets(packets, profile="legacy"))


@query(
    with_views(
        DATAGRAMS,
        f"""SELECT flow_id, counter,
              CASE WHEN CASE WHEN counter = 0 THEN 24 + strlen(header) ELSE 16 END + strlen(piece) // 2 > {MAX_PACKET}
                THEN 'cut' WHEN counter = 0 THEN 'first' ELSE 'data' END AS kind FROM datagrams""",
    )
)
def packets_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = dg.encode_packets(views.datagrams(spark, sf_dir))
    marked = sent.select(F.col("flow_id").alias("sent_flow"), F.col("counter").alias("sent_counter"), "packet")
    parsed = dg.parse_packets(marked, max_size=MAX_PACKET)
    return parsed.select(F.col("sent_flow").alias("flow_id"), F.col("sent_counter").alias("counter"), "kind")


@query(
    with_views(
        DATAGRAMS,
        """SELECT flow_id, counter, CASE WHEN flow_id % 3 = 0 THEN 'failure' ELSE 'success' END AS outcome,
             CASE WHEN flow_id % 3 = 0 THEN 'flow_id_range' END AS reason FROM datagrams""",
    )
)
def packets_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third flow has a number that needs more than 32 bits."""
    wide = F.when(F.col("flow_id") % 3 == 0, F.lit(2**33)).otherwise(F.lit(0))
    sent = views.datagrams(spark, sf_dir).withColumn("flow_id", F.col("flow_id") + wide)
    return dg.encode_packets(sent).select((F.col("flow_id") % 2**33).alias("flow_id"), "counter", "outcome", "reason")


@query(
    with_views(
        SHORT_FLOWS, "SELECT flow_id, 'success' AS outcome, size, md5(text) AS content_md5, true AS length_ok FROM flows"
    )
)
def reassemble_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = dg.packetize(views.short_flows(spark, sf_dir), profile="legacy")
    return flow_report(dg.reassemble(sent.filter(F.col("outcome") == SUCCESS).drop("outcome"), profile="legacy"))


@query(
    with_views(
        ARRIVALS,
        f""", seen AS (
             SELECT flow_id, count(DISTINCT counter) AS pieces, min(counter) AS lowest FROM arrivals GROUP BY flow_id),
           judged AS (
             SELECT a.flow_id, a.size, a.hexed, a.fill, a.n, s.pieces = a.n AS whole
             FROM seen s JOIN announced a ON s.flow_id = a.flow_id WHERE s.lowest = 0),
           parts AS (
             SELECT *, CASE WHEN part_no = 0 THEN 0 ELSE fill + ({PART_PIECES} * part_no - 1) * 468 END AS start
             FROM (SELECT *, unnest(generate_series(0, CASE WHEN whole THEN (n - 1) // {PART_PIECES} ELSE 0 END)) AS part_no
                   FROM judged))
           SELECT flow_id, part_no, CASE WHEN whole THEN start END AS "offset", CASE WHEN whole THEN size END AS size,
             CASE WHEN whole THEN md5(unhex(substr(hexed, 2 * start + 1,
               2 * (fill + ({PART_PIECES} * part_no + {PART_PIECES - 1}) * 468 - start)))) END AS content_md5,
             CASE WHEN whole THEN 'success' ELSE 'error' END AS outcome, CASE WHEN whole THEN true END AS length_ok
           FROM parts""",
    )
)
def reassemble_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dg.reassemble_parts(views.arrivals(spark, sf_dir), part_pieces=PART_PIECES)
    return parts.select(
        "flow_id", "part_no", "offset", "size", F.md5("content").alias("content_md5"), "outcome", "length_ok"
    )


# --- network -----------------------------------------------------------------------------------


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS conn_no FROM events")
def connections_per_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    assigned = network.assign_connections(events, "user_id", "ts", per_flow=True, tie_break=["event_id"])
    return assigned.select("event_id", "user_id", "conn_no")


@query(
    f"""SELECT event_id, ip FROM (
          SELECT event_id, ip, CAST(p[1] AS BIGINT) * 16777216 + CAST(p[2] AS BIGINT) * 65536 + CAST(p[3] AS BIGINT) * 256
            + CAST(p[4] AS BIGINT) AS num
          FROM (SELECT event_id, {EVENT_IP} AS ip, string_split({EVENT_IP}, '.') AS p FROM events))
        WHERE num BETWEEN 167837697 AND 167903230 OR num BETWEEN 167919617 AND 167935998 OR ip = '10.3.5.7'
          OR num BETWEEN 3232235521 AND 3232235774"""
)
def ip_allowed_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older rule: blocks admit inner hosts only."""
    events = views.table(spark, sf_dir, "events").select("event_id", views.event_address().alias("ip"))
    return network.ip_allowlist_filter(events, "ip", views.ALLOWLIST, compat=True)


# --- any number of flows at one time --


@query("SELECT event_id, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR))) AS flow_no FROM events")
def flow_ids_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sender, all flows in one second, in the order of hashes."""
    events = views.table(spark, sf_dir, "events").select(
        "event_id", F.lit("10.0.0.1").alias("sender"), F.lit(views.EPOCH).cast("timestamp").alias("ts"),
        F.md5(F.col("event_id").cast("string").cast("binary")).alias("tie"),
    )
    numbered = network.assign_flow_ids(events, "sender", "ts", tie_break=["tie"], block_seconds=None)
    return numbered.select("event_id", "flow_no")


@query(
    """SELECT event_id, CAST(sum(opens) OVER (ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS conn_no
       FROM (SELECT event_id, ms, CASE WHEN ms - lag(ms) OVER (ORDER BY ms, event_id) <= 300 THEN 0 ELSE 1 END AS opens
             FROM (SELECT event_id, event_id * 7919 % 3600000 AS ms FROM events))"""
)
def connections_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One destination, all flows in one hour."""
    ms = F.unix_millis(F.lit(views.EPOCH).cast("timestamp")) + F.col("event_id") * 7919 % 3_600_000
    events = views.table(spark, sf_dir, "events").select(
        "event_id", F.lit("10.0.0.1").alias("dest"), F.timestamp_millis(ms).alias("ts")
    )
    assigned = network.assign_connections(events, "dest", "ts", 0.3, tie_break=["event_id"], block_seconds=None)
    return assigned.select("event_id", "conn_no")


# --- lists and checksums of any size -----------------------------------------------------------


_LISTED = """WITH listed AS (
         SELECT base // size AS network, size, 24 + k % 9 AS length, k % 5 <> 0 AS admits, vf, CASE WHEN k % 3 > 0 THEN vf + INTERVAL 10 DAY END AS vt
         FROM (SELECT c_custkey AS k, 167772160 + (c_custkey % 4) * 65536 + (c_custkey % 256) * 256 + c_custkey * 7 % 256 AS base,
                 CAST(2 ** (8 - c_custkey % 9) AS BIGINT) AS size,
                 TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS vf FROM customer)),
       sent AS (SELECT event_id, ts, {ip} AS ip, 167772160 + (user_id % 4) * 65536 + (event_id % 256) * 256 + user_id % 256 AS num FROM events),
       admitted AS (
         SELECT event_id FROM sent JOIN listed ON num // size = network AND ts >= vf AND (vt IS NULL OR ts < vt)
         GROUP BY event_id HAVING max(2 * length + CASE WHEN admits THEN 0 ELSE 1 END) % 2 = 0)
       SELECT event_id, ip FROM sent WHERE event_id {which} (SELECT event_id FROM admitted)"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block for each customer: some reject, some hold for ten days only."""
    k = F.col("c_custkey")
    begin = F.timestamp_seconds(F.unix_seconds(F.lit(views.EPOCH).cast("timestamp")) + k % 30 * 86_400)
    return views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("10."), k % 4, F.lit("."), k % 256, F.lit("."), k * 7 % 256, F.lit("/"), 24 + k % 9).alias("entry"),
        (k % 5 != 0).alias("admits"),
        begin.alias("valid_from"),
        F.when(k % 3 > 0, begin + F.expr("INTERVAL 10 DAYS")).alias("valid_to"),
    )


def _by_table(spark: SparkSession, sf_dir: str, rejected: bool) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", views.event_address().alias("ip"), F.col("ts").cast("timestamp").alias("ts"))
    return network.ip_table_filter(events, "ip", _blocks(spark, sf_dir), at="ts", rejected=rejected).select("event_id", "ip")


@query(_LISTED.format(ip=EVENT_IP, which="IN"))
def ip_allowed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(spark, sf_dir, rejected=False)


@query(_LISTED.format(ip=EVENT_IP, which="NOT IN"))
def ip_rejected_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(spark, sf_dir, rejected=True)


@query(
    """SELECT doc_id AS flow_id, CASE WHEN doc_id % 17 = 0 OR doc_id % 23 = 0 THEN 'error' ELSE 'match' END AS status
       FROM documents"""
)
def verify_checksums_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows are received in parts of 700 bytes; the sender's checksums were made of whole flows."""
    flows = views.flows(spark, sf_dir).select("flow_id", "content", F.lit(0).cast("bigint").alias("offset"))
    tree = {"leaf_bytes": 256, "fan": 4, "levels": 6}
    expected = outcomes.tree_checksums(flows, **tree)
    altered = F.when(F.col("flow_id") % 17 == 0, F.concat("content", F.encode(F.lit("x"), "UTF-8")))
    received = flows.filter(F.col("flow_id") % 23 != 0).withColumn("content", altered.otherwise(F.col("content")))
    last = F.call_function("div", F.greatest(F.octet_length("content"), F.lit(1)) - 1, F.lit(700))
    parts = received.select("flow_id", "content", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("part_no"))
    parts = parts.select(
        "flow_id",
        (F.col("part_no") * 700).alias("offset"),
        binary.slice_bytes(F.col("content"), F.col("part_no") * 700, F.lit(700)).alias("content"),
    )
    return outcomes.verify_checksums_parts(parts, expected, **tree).select("flow_id", "status")
