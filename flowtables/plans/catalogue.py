"""Every registered query: the Spark plan and, where SQL can say it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.operators import attributes as attrs
from flowtables.operators import datagrams as dg
from flowtables.operators import framed, network, outcomes
from flowtables.operators.timeouts import classify_timeouts
from flowtables.plans import views
from flowtables.plans.views_sql import (
    ALL_ARRIVALS,
    ALL_DATAGRAMS,
    ARRIVALS,
    DATAGRAMS,
    EVENT_IP,
    FLOWS,
    FRAMES,
    UNLOST_ARRIVALS,
    with_views,
)
from flowtables.schema import FAILURE, SUCCESS
from flowtables.sources.capture import read_capture, write_capture
from flowtables.sources.flows import write_outcomes
from flowtables.sources.workdir import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


# --- flows and attributes ----------------------------------------------------------------------


@query(with_views(FLOWS, "SELECT flow_id, size, md5(text) AS content_md5 FROM flows"))
def flows_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flows(spark, sf_dir).select("flow_id", "size", F.md5("content").alias("content_md5"))


def _selection(name: str, entries: str, **selection) -> None:
    sql = with_views(
        FLOWS,
        f"""SELECT flow_id, '{{' || array_to_string(list_transform({entries},
                lambda e: '"' || e.k || '":"' || e.v || '"'), ',') || '}}' AS header_json
            FROM flows""",
    )

    @query(sql, name)
    def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = attrs.select_attributes(views.flows(spark, sf_dir), **selection)
        return attrs.encode_attributes(chosen).select("flow_id", "header_json")


def _kept(condition: str) -> str:
    return f"list_filter(entries, lambda e: {condition})"


def _listed(*names: str) -> str:
    value = "coalesce(list_filter(entries, lambda e: e.k = '{0}')[1].v, '')"
    return "[" + ", ".join(f"{{'k': '{n}', 'v': {value.format(n)}}}" for n in names) + "]"


_selection("select_all", "entries")
_selection("select_list", _listed("absent", "lang", "note", "priority"), names=views.LISTED)
_selection("select_regex", _kept("e.k IN ('source', 'lang', 'uuid')"), regex=views.PATTERN)
_selection("select_no_core", _kept("e.k IN ('big', 'lang', 'note', 'source')"), include_core=False)
_selection("select_list_no_core", _listed("absent", "lang", "note"), names=views.LISTED, include_core=False)
_selection(
    "select_regex_no_core", _kept("e.k IN ('source', 'lang', 'uuid')"), regex=views.PATTERN, include_core=False
)


@query(with_views(FLOWS, "SELECT flow_id, header AS header_json, strlen(header) AS header_len FROM flows"))
def encode_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attrs.encode_attributes(views.flows(spark, sf_dir)).select(
        "flow_id", "header_json", F.col("header_len").cast("bigint").alias("header_len")
    )


@query(
    """SELECT event_id, props ->> '$.k' AS k, 'number' AS k_type, '"' || event_type || '"' AS kind, 'string' AS kind_type
       FROM events"""
)
def type_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = attrs.decode_attributes(views.table(spark, sf_dir, "events"), "props")
    with_type = F.map_concat("attributes", F.create_map(F.lit("kind"), F.col("event_type")))
    typed = attrs.type_attributes(events.withColumn("attributes", with_type))
    json_type = attrs.headers.json_type
    return typed.select(
        "event_id",
        F.col("typed.k").alias("k"),
        json_type(F.col("typed.k")).alias("k_type"),
        F.col("typed.kind").alias("kind"),
        json_type(F.col("typed.kind")).alias("kind_type"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN props ->> '$.k' END AS k,
         CASE WHEN event_id % 13 = 0 THEN 'error' ELSE 'success' END AS outcome
       FROM events"""
)
def decode_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.expr("case when event_id % 13 = 0 then left(props, length(props) - 1) else props end")
    events = views.table(spark, sf_dir, "events").withColumn("header", cut)
    return attrs.decode_attributes(events, "header").select("event_id", F.col("attributes.k").alias("k"), "outcome")


@query(
    with_views(
        FLOWS,
        """SELECT flow_id, replace(header, ',"uuid"', ',"tcp.receiver":"127.0.0.1","tcp.receiver_port":"6666","tcp.sender":"'
             || source || '","uuid"') AS header_json
           FROM flows""",
    )
)
def endpoint_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = views.sent_flows(spark, sf_dir)
    with_ends = attrs.add_endpoint_attributes(flows, F.col("source"), "127.0.0.1", 6666)
    return attrs.encode_attributes(with_ends).select("flow_id", "header_json")


@query(with_views(FLOWS, "SELECT flow_id, u.k AS key, u.v AS value FROM (SELECT flow_id, unnest(entries) AS u FROM flows)"))
def attributes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attrs.attributes_long(views.flows(spark, sf_dir))


# --- streams of bytes --------------------------------------------------------------------------


@query(
    with_views(
        FRAMES,
        """, streams AS (
             SELECT conn_id, string_agg(frame, '' ORDER BY flow_id) AS hexed FROM frames GROUP BY conn_id)
           SELECT conn_id, seq * 1000 AS "offset", strlen(substr(hexed, 2000 * seq + 1, 2000)) // 2 AS len,
             md5(unhex(substr(hexed, 2000 * seq + 1, 2000))) AS md5
           FROM (SELECT conn_id, hexed, unnest(generate_series(0, (strlen(hexed) // 2 - 1) // 1000)) AS seq FROM streams)""",
    )
)
def framed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.framed_segments(spark, sf_dir).select(
        "conn_id", "offset", F.octet_length("bytes").cast("bigint").alias("len"), F.md5("bytes").alias("md5")
    )


def frame_report(frames: DataFrame) -> DataFrame:
    return frames.select("conn_id", "frame_no", "size", F.md5("content").alias("content_md5"), "outcome", "truncated")


FRAMES_SQL = with_views(
    FRAMES,
    """SELECT conn_id, frame_no, size, md5(text) AS content_md5, 'success' AS outcome, false AS truncated FROM frames""",
)


@query(FRAMES_SQL)
def framed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_report(framed.segments_to_flows(views.landed(spark, views.framed_segments(spark, sf_dir), "segments")))


TRUNCATED_SQL = with_views(
    FRAMES,
    """, cut AS (
         SELECT *, CASE WHEN conn_id % 10 = 3 THEN total * 9 // 10 ELSE total END AS closed,
           frame_end - size AS body_start
         FROM placed),
       seen AS (SELECT *, closed < frame_end AS truncated, greatest(least(closed, frame_end) - body_start, 0) AS got FROM cut)
       SELECT conn_id, frame_no, CAST(got AS BIGINT) AS size,
         md5(unhex(substr(hex(encode(text)), 1, CAST(2 * got AS BIGINT)))) AS content_md5, 'success' AS outcome, truncated
       FROM seen WHERE NOT truncated OR frame_no = 0 OR got > 0""",
)


@query(TRUNCATED_SQL)
def framed_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_report(framed.segments_to_flows(views.landed(spark, views.truncated_segments(spark, sf_dir), "segments")))


@query(
    """SELECT conv_id, CAST(sum(strlen(text)) AS BIGINT) AS size, md5(string_agg(text, '' ORDER BY turn)) AS content_md5
       FROM conversations GROUP BY conv_id"""
)
def raw_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = framed.raw_streams_to_flows(views.raw_segments(spark, sf_dir), "conv_id", "seq")
    return whole.select("conv_id", "size", F.md5("content").alias("content_md5"))


@query(
    """SELECT doc_id, i - 1 AS msg_no, strlen(lines[i]) AS len, md5(lines[i]) AS content_md5
       FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i
             FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
       WHERE i < len(lines) OR lines[i] <> ''"""
)
def delimited_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = views.table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(0).cast("bigint").alias("seq"), F.encode("text", "UTF-8").alias("bytes")
    )
    messages = framed.delimited_streams_to_flows(segments, b"\n", "doc_id", "seq")
    return messages.select(
        "doc_id", "msg_no", F.octet_length("content").cast("bigint").alias("len"), F.md5("content").alias("content_md5")
    )


# --- datagrams ---------------------------------------------------------------------------------


def _piece_report(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "flow_id",
        F.col("n_datagrams").cast("bigint").alias("n_datagrams"),
        "counter",
        F.octet_length("payload").cast("bigint").alias("len"),
        F.md5("payload").alias("md5"),
        "outcome",
    )


@query(
    with_views(
        ALL_DATAGRAMS,
        """SELECT flow_id, n AS n_datagrams, counter, strlen(piece) // 2 AS len, md5(unhex(piece)) AS md5,
             'success' AS outcome FROM datagrams
           UNION ALL SELECT flow_id, NULL, NULL, NULL, NULL, 'failure' FROM flows WHERE strlen(header) > 460""",
    )
)
def packetize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _piece_report(dg.packetize(views.sent_flows(spark, sf_dir), views.DATAGRAM_SIZE))


@query(
    with_views(
        FLOWS,
        """, cut AS (
             SELECT *, 1426 - strlen(header) AS fill, hex(encode(text)) AS hexed,
               greatest(CAST(ceil((size - (1426 - strlen(header))) / 1450.0) AS BIGINT), 0) AS later FROM flows),
           pieces AS (
             SELECT flow_id, later, counter, CASE WHEN counter = 0 THEN substr(hexed, 1, 2 * fill)
               ELSE substr(hexed, 2 * (fill + (counter - 1) * 1450) + 1, 2900) END AS piece
             FROM (SELECT *, unnest(generate_series(0, later)) AS counter FROM cut WHERE fill >= 0))
           SELECT flow_id, later AS n_datagrams, counter, strlen(piece) // 2 AS len, md5(unhex(piece)) AS md5,
             'success' AS outcome FROM pieces
           UNION ALL SELECT flow_id, NULL, NULL, NULL, NULL, 'failure' FROM cut WHERE fill < 0""",
    )
)
def packetize_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _piece_report(dg.packetize(views.sent_flows(spark, sf_dir), profile="legacy"))


@query(
    with_views(
        DATAGRAMS,
        """SELECT kind, count(*) AS n, CAST(coalesce(sum(CASE WHEN kind IN ('first', 'data') THEN strlen(piece) // 2 END), 0)
             AS BIGINT) AS payload_bytes
           FROM (SELECT piece, CASE WHEN (flow_id + counter) % 23 = 0 THEN 'malformed'
                   WHEN (flow_id + counter) % 19 = 0 THEN 'unknown_type'
                   WHEN counter = 0 THEN 'first' ELSE 'data' END AS kind FROM datagrams) GROUP BY kind""",
    )
)
def parse_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = dg.encode_packets(views.datagrams(spark, sf_dir))
    mark = F.col("flow_id") + F.col("counter")
    packet = F.col("packet")
    broken = (
        F.when(mark % 23 == 0, F.substring(packet, 1, 10))
        .when(mark % 19 == 0, F.concat(dg.binary.int32_bytes(F.lit(3)), F.substring(packet, F.lit(5), F.octet_length(packet))))
        .otherwise(packet)
    )
    return dg.packet_counts(dg.parse_packets(sent.select(broken.alias("packet"))))


@query(
    with_views(
        ARRIVALS, "SELECT flow_id, counter, max(arrival_seq) AS arrival_seq FROM arrivals GROUP BY source, flow_id, counter"
    )
)
def dedupe_datagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.dedupe_datagrams(views.arrivals(spark, sf_dir)).select("flow_id", "counter", "arrival_seq")


@query(
    with_views(
        ARRIVALS,
        """SELECT d.flow_id, d.counter FROM datagrams d
           WHERE EXISTS (SELECT 1 FROM arrivals a WHERE a.flow_id = d.flow_id AND a.counter = 0)
             AND NOT EXISTS (SELECT 1 FROM arrivals a WHERE a.flow_id = d.flow_id AND a.counter = d.counter)""",
    )
)
def missing_datagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.missing_datagrams(views.arrivals(spark, sf_dir)).select("flow_id", "counter")


@query(
    with_views(
        ARRIVALS,
        """SELECT DISTINCT flow_id, counter FROM arrivals a
           WHERE NOT EXISTS (SELECT 1 FROM arrivals b WHERE b.flow_id = a.flow_id AND b.counter = 0)""",
    )
)
def orphan_datagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.orphan_datagrams(views.arrivals(spark, sf_dir)).select("flow_id", "counter")


@query(
    with_views(
        ARRIVALS,
        """, ranked AS (
             SELECT flow_id, counter, counter - row_number() OVER (PARTITION BY flow_id ORDER BY counter) AS gap
             FROM (SELECT DISTINCT flow_id, counter FROM arrivals))
           SELECT flow_id, coalesce(max(counter) FILTER (gap = -1), -1) AS right_boundary FROM ranked GROUP BY flow_id""",
    )
)
def contiguous_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.contiguous_prefix(views.arrivals(spark, sf_dir)).select("flow_id", "right_boundary")


@query(
    with_views(
        ARRIVALS,
        """, first AS (SELECT flow_id, counter, min(arrival_ms) AS ms FROM arrivals GROUP BY flow_id, counter),
           ranked AS (
             SELECT flow_id, counter, counter - row_number() OVER w AS gap, max(ms) OVER w AS usable_ms
             FROM first WINDOW w AS (PARTITION BY flow_id ORDER BY counter))
           SELECT flow_id, counter, usable_ms FROM ranked WHERE gap = -1""",
    )
)
def prefix_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.prefix_progress(views.arrivals(spark, sf_dir), at="arrival_ms").drop("source")


@query(
    with_views(
        ARRIVALS,
        """, first AS (SELECT flow_id, n, counter, min(arrival_ms) AS ms FROM arrivals GROUP BY flow_id, n, counter)
           SELECT flow_id, CASE WHEN count(*) = n AND max(ms) - min(ms) FILTER (counter = 0) <= 2000
               THEN 'success' ELSE 'timeout' END AS outcome
           FROM first GROUP BY flow_id, n HAVING min(counter) = 0""",
    ),
    "classify_timeouts",
)
def timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_timeouts(views.arrivals(spark, sf_dir), 2000, at="arrival_ms").select("flow_id", "outcome")


_REASSEMBLED = """, seen AS (
         SELECT flow_id, count(DISTINCT counter) AS pieces, min(counter) AS lowest FROM arrivals GROUP BY flow_id)
       SELECT s.flow_id, CASE WHEN s.pieces = a.n THEN 'success' ELSE 'error' END AS outcome,
         CASE WHEN s.pieces = a.n THEN a.size END AS size, CASE WHEN s.pieces = a.n THEN md5(a.text) END AS content_md5,
         CASE WHEN s.pieces = a.n THEN true END AS length_ok
       FROM seen s JOIN announced a ON s.flow_id = a.flow_id WHERE s.lowest = 0"""
REASSEMBLE_SQL = with_views(ARRIVALS, _REASSEMBLED)


def flow_report(flows: DataFrame) -> DataFrame:
    return flows.select("flow_id", "outcome", "size", F.md5("content").alias("content_md5"), "length_ok")


@query(REASSEMBLE_SQL)
def reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_report(dg.reassemble(views.arrivals(spark, sf_dir)))


@query(
    with_views(
        ARRIVALS,
        """SELECT DISTINCT a.flow_id, a.counter, strlen(a.piece) // 2 AS len, md5(unhex(a.piece)) AS md5 FROM arrivals a
           WHERE (SELECT count(DISTINCT b.counter) FROM arrivals b WHERE b.flow_id = a.flow_id) = a.n""",
    )
)
def reassemble_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = dg.reassemble(views.arrivals(spark, sf_dir), output="chunks")
    return pieces.select(
        "flow_id", "counter", F.octet_length("payload").cast("bigint").alias("len"), F.md5("payload").alias("md5")
    )


@query(
    with_views(
        UNLOST_ARRIVALS,
        """, sums AS (
             SELECT flow_id, count(*) AS datagrams,
               CAST(sum(strlen(piece) // 2 + CASE WHEN counter > 0 THEN 16 ELSE 0 END) AS BIGINT) AS bytes,
               (max(arrival_ms) - min(arrival_ms)) / 1000.0 AS elapsed_s
             FROM arrivals GROUP BY flow_id)
           SELECT flow_id, datagrams, bytes, round(CAST(elapsed_s AS DOUBLE), 6) AS elapsed_s,
             round(CAST(datagrams / nullif(elapsed_s, 0) AS DOUBLE), 6) AS pps,
             round(CAST(bytes * 8 / nullif(elapsed_s, 0) / 1000000 AS DOUBLE), 6) AS mbit FROM sums""",
    )
)
def transfer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = dg.transfer_stats(views.network(views.datagrams(spark, sf_dir), loses=False), at="arrival_ms")
    rounded = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("elapsed_s", "pps", "mbit")]
    return stats.select("flow_id", "datagrams", "bytes", *rounded)


@query(
    with_views(
        UNLOST_ARRIVALS,
        """SELECT source, count(*) AS datagrams, min(arrival_ms) AS first_ms, max(arrival_ms) AS last_ms,
             max(arrival_ms) - min(arrival_ms) AS running_ms FROM arrivals GROUP BY source""",
    )
)
def receiver_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.receiver_totals(views.network(views.datagrams(spark, sf_dir), loses=False), at="arrival_ms")


@query(
    with_views(
        UNLOST_ARRIVALS,
        """SELECT source, flow_id, count(*) AS datagrams, min(arrival_ms) AS first_ms, max(arrival_ms) AS last_ms,
             max(arrival_ms) - min(arrival_ms) AS running_ms FROM arrivals GROUP BY ROLLUP (source, flow_id)""",
    )
)
def receiver_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dg.receiver_totals(views.network(views.datagrams(spark, sf_dir), loses=False), at="arrival_ms", subtotals=True)


@query(
    with_views(
        DATAGRAMS,
        """SELECT flow_id, counter, CASE WHEN counter <= 1 THEN 0.0 ELSE round(CAST(counter * 1000.0 / 300 AS DOUBLE), 6) END
             AS send_ms FROM datagrams""",
    )
)
def pacing_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    paced = dg.pacing_schedule(views.datagrams(spark, sf_dir), max_pps=300)
    return paced.select("flow_id", "counter", F.round("send_ms", 6).alias("send_ms"))


# --- network and outcomes ----------------------------------------------------------------------


_ADMITTED = f"""
  SELECT event_id, ip, (CAST(p[1] AS BIGINT) * 16777216 + CAST(p[2] AS BIGINT) * 65536 + CAST(p[3] AS BIGINT) * 256
      + CAST(p[4] AS BIGINT)) AS num
  FROM (SELECT event_id, {EVENT_IP} AS ip, string_split({EVENT_IP}, '.') AS p FROM events)"""
_IN_LIST = """(num BETWEEN 167837696 AND 167903231 OR num BETWEEN 167919616 AND 167935999
  OR ip = '10.3.5.7' OR num BETWEEN 3232235520 AND 3232235775)"""


@query(f"SELECT event_id, ip FROM ({_ADMITTED}) WHERE {_IN_LIST}")
def ip_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", views.event_address().alias("ip"))
    return network.ip_allowlist_filter(events, "ip", views.ALLOWLIST)


@query(f"SELECT event_id, ip FROM ({_ADMITTED}) WHERE NOT {_IN_LIST}")
def ip_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", views.event_address().alias("ip"))
    return network.ip_allowlist_filter(events, "ip", views.ALLOWLIST, rejected=True)


@query(
    """SELECT doc_id AS flow_id, CASE WHEN doc_id % 17 = 0 OR doc_id % 23 = 0 THEN 'error' ELSE 'match' END AS status
       FROM documents"""
)
def verify_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = views.flows(spark, sf_dir)
    expected = flows.select("flow_id", F.md5("content").alias("md5"))
    altered = F.when(F.col("flow_id") % 17 == 0, F.concat("content", F.encode(F.lit("x"), "UTF-8")))
    received = flows.filter(F.col("flow_id") % 23 != 0).withColumn("content", altered.otherwise(F.col("content")))
    return outcomes.verify_checksums(received, expected).select("flow_id", "status")


@query(
    f"""SELECT outcome, count(*) AS n FROM (
          SELECT outcome FROM ({with_views(ALL_ARRIVALS, _REASSEMBLED)})
          UNION ALL SELECT 'failure' FROM ({with_views(ALL_DATAGRAMS, "SELECT flow_id FROM flows WHERE strlen(header) > 460")}))
        GROUP BY outcome"""
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = dg.packetize(views.sent_flows(spark, sf_dir), views.DATAGRAM_SIZE)
    unsent = sent.filter(F.col("outcome") == FAILURE).select("outcome")
    received = dg.flow_status(views.network(sent.filter(F.col("outcome") == SUCCESS).drop("outcome")))
    return outcomes.outcome_counts(received.select("outcome").unionByName(unsent))


@query(
    f"""SELECT 'tcp://' || {EVENT_IP} || ':6666' AS transit_uri, count(*) AS flows,
          CAST(sum(strlen(props)) AS BIGINT) AS bytes, round(sum(value), 4) AS elapsed_ms
        FROM events GROUP BY 1"""
)
def transfer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    log = network.transfer_log(events, views.event_address(), 6666, "value", F.octet_length("props"))
    return network.transfer_log_summary(log).withColumn("elapsed_ms", F.round("elapsed_ms", 4))


@query(
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS flow_no
       FROM events"""
)
def flow_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    numbered = network.assign_flow_ids(events, "user_id", "ts", F.to_date("ts"), ["event_id"])
    return numbered.select("event_id", "user_id", "flow_no")


@query(
    """SELECT event_id, user_id,
         CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS conn_no
       FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR
               THEN 0 ELSE 1 END AS opens FROM events)"""
)
def connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    assigned = network.assign_connections(events, "user_id", "ts", 6 * 3600, tie_break=["event_id"])
    return assigned.select("event_id", "user_id", "conn_no")


@query(
    with_views(
        ALL_DATAGRAMS,
        """SELECT CASE WHEN strlen(header) <= 460 THEN 'success' ELSE 'failure' END AS outcome, flow_id, size,
             md5(text) AS content_md5 FROM flows""",
    ),
    "write_outcomes",
)
def outcomes_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = attrs.encode_attributes(views.flows(spark, sf_dir))
    fits = F.col("header_len") <= views.DATAGRAM_SIZE - 52
    routed = flows.withColumn("outcome", F.when(fits, "success").otherwise("failure"))
    path = work_dir(spark, "outcomes")
    write_outcomes(routed, path)
    return spark.read.parquet(path).select("outcome", "flow_id", "size", F.md5("content").alias("content_md5"))


@query(with_views(FLOWS, "SELECT 'doc_' || flow_id || '.txt' AS filename, size, md5(text) AS content_md5, 'success' AS outcome FROM flows"))
def flowcapture_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "capture")
    write_capture(views.flows(spark, sf_dir), path)
    flows = read_capture(spark, path)
    return flows.select(
        F.col("attributes.filename").alias("filename"), "size", F.md5("content").alias("content_md5"), "outcome"
    )
