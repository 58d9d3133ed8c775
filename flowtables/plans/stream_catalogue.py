"""The registered streaming queries: each lands a view as files, streams it and reads the result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.operators.attributes import encode_attributes
from flowtables.plans import views
from flowtables.plans.catalogue import FRAMES_SQL, REASSEMBLE_SQL, TRUNCATED_SQL, flow_report, frame_report, query
from flowtables.plans.views_sql import ARRIVALS, FLOWS, FRAMES, with_views
from flowtables.sources.workdir import work_dir
from flowtables.streaming.framed import flows_of_parts, segment_losses, stream_frame_parts
from flowtables.streaming.parts import datagram_losses, reassembled_parts, stream_reassemble_parts
from flowtables.streaming.reassembly import stream_reassemble
from flowtables.streaming.replay import replay
from flowtables.streaming.transfer import transfer_stream
from flowtables.streaming.windows import stream_dedupe, stream_raw_sessions, stream_throughput

# Of the queries in one micro-batch: the views span a month, nothing is late, and the closing row ends everything.
_WHOLE_VIEW = "40 days"
_CLOSING = "2030-01-01"
_DAY_MS = 86_400_000


def _closing_row(spark: SparkSession, rows: DataFrame, ts: str, **values) -> DataFrame:
    """A row of nulls but for the time and the given values."""
    given = {ts: F.lit(_CLOSING).cast("timestamp"), **{k: F.lit(v) for k, v in values.items()}}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]
    return spark.range(1).select(*columns)


@query(REASSEMBLE_SQL, "stream_reassemble")
def reassembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = views.arrivals(spark, sf_dir)
    # A keepalive carries no piece but moves the clock.
    keepalive = _closing_row(spark, arrivals, "arrival_ts", header_type=3)
    flows = replay(
        spark,
        arrivals,
        lambda landed: stream_reassemble(landed, _DAY_MS, _WHOLE_VIEW, keep_ms=_DAY_MS),
        "stream_reassemble",
        keepalive,
    )
    return flow_report(flows)


#: Pieces per part of a flow, and micro-batches, of the queries over several of them.
PART_PIECES = 8
_BATCHES = 10


@query(
    with_views(
        ARRIVALS,
        f""", first AS (SELECT flow_id, counter, min(arrival_ms) AS ms FROM arrivals GROUP BY flow_id, counter),
           judged AS (
             SELECT f.flow_id, count(*) = any_value(a.n) AND max(ms) - min(ms) FILTER (f.counter = 0) <= 2000 AS good
             FROM first f JOIN announced a USING (flow_id) GROUP BY f.flow_id HAVING min(f.counter) = 0)
           SELECT j.flow_id, CASE WHEN good THEN p.part_no ELSE 0 END AS part_no, CASE WHEN good THEN a.size END AS size,
             CASE WHEN good THEN md5(unhex(string_agg(d.piece, '' ORDER BY d.counter))) END AS content_md5,
             CASE WHEN good THEN 'success' ELSE 'error' END AS outcome, CASE WHEN NOT good THEN 'timeout' END AS reason
           FROM judged j JOIN announced a USING (flow_id) JOIN datagrams d USING (flow_id),
             LATERAL (SELECT d.counter // {PART_PIECES} AS part_no) p
           WHERE good OR d.counter = 0
           GROUP BY j.flow_id, good, a.size, p.part_no""",
    ),
    "stream_reassemble_parts",
)
def reassembled_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reassembled_parts(_streamed_parts(spark, sf_dir)).select(
        "flow_id", "part_no", "size", F.md5("content").alias("content_md5"), "outcome", "reason"
    )


@query(
    with_views(
        ARRIVALS,
        """, first AS (
             SELECT flow_id, counter, count(*) AS came, min(arrival_ms) AS ms FROM arrivals GROUP BY flow_id, counter),
           lost AS (
             SELECT flow_id, CAST(sum(came) - count(*) AS BIGINT) AS repeated,
               count(*) FILTER (ms > begun + 2000) AS late, count(*) FILTER (begun IS NULL) AS orphaned, CAST(0 AS BIGINT) AS unknown
             FROM (SELECT *, min(ms) FILTER (counter = 0) OVER (PARTITION BY flow_id) AS begun FROM first) GROUP BY flow_id)
           SELECT * FROM lost WHERE repeated + late + orphaned > 0""",
    )
)
def stream_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = datagram_losses(_streamed_parts(spark, sf_dir))
    return losses.select("flow_id", "repeated", "late", "orphaned", "unknown")


def _streamed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals in as many micro-batches as there are stretches of time, with real timeouts."""
    arrivals = views.arrivals(spark, sf_dir)
    # The view's flows begin over 5,000 seconds.
    stretch = F.floor(F.col("arrival_ms") * _BATCHES / F.lit(5_100_000))
    return replay(
        spark,
        arrivals,
        lambda landed: stream_reassemble_parts(landed, 2000, "10 seconds", part_pieces=PART_PIECES),
        "stream_reassemble_parts",
        _closing_row(spark, arrivals, "arrival_ts", header_type=3),
        batch=stretch,
    )


@query(FRAMES_SQL)
def stream_framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_report(flows_of_parts(_streamed_frames(spark, views.framed_segments(spark, sf_dir))))


@query(TRUNCATED_SQL)
def stream_framed_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_report(flows_of_parts(_streamed_frames(spark, views.truncated_segments(spark, sf_dir))))


@query(
    with_views(
        FRAMES,
        f"""SELECT conn_id, CAST(count(*) FILTER (seq % 7 = 3 AND seq <> 4) AS BIGINT) AS repeated,
             CAST(count(*) FILTER (seq > 4) AS BIGINT) AS lost
           FROM (SELECT conn_id, unnest(generate_series(0, CAST((max(total) - 1) // {views.SEGMENT_BYTES} AS BIGINT))) AS seq FROM placed GROUP BY conn_id)
           GROUP BY conn_id HAVING count(*) FILTER (seq % 7 = 3 OR seq > 4) > 0""",
    )
)
def stream_segment_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment 4 of every connection is lost and every seventh comes twice."""
    segments = views.framed_segments(spark, sf_dir).filter("seq <> 4")
    copies = F.explode(F.when(F.col("seq") % 7 == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0))))
    return segment_losses(_streamed_frames(spark, segments.select("*", copies.alias("copy")).drop("copy")))


def _streamed_frames(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """Connections open one after the other; half of them say which segment is their last, the others fall idle."""
    last = segments.groupBy("conn_id").agg(F.max("seq").alias("last"))
    seconds = F.col("conn_id") * 60 + F.col("seq") % 1000
    timed = segments.join(last, "conn_id").select(
        "conn_id",
        "seq",
        "bytes",
        ((F.col("conn_id") % 2 == 0) & (F.col("seq") == F.col("last"))).alias("closes"),
        F.timestamp_seconds(F.unix_seconds(F.lit(views.EPOCH).cast("timestamp")) + seconds).alias("ts"),
    )
    passed = F.unix_seconds("ts") - F.unix_seconds(F.lit(views.EPOCH).cast("timestamp"))
    return replay(
        spark,
        timed,
        lambda landed: stream_frame_parts(landed, closes="closes", idle_ms=1_200_000, watermark="1 minute", part_bytes=700),
        "stream_framed",
        _closing_row(spark, timed, "ts", conn_id=-1, seq=0),
        batch=F.floor(passed * _BATCHES / F.lit(views.CONNECTIONS * 60 + 1000)),
    )


@query(
    """SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n,
         CAST(sum(strlen(props)) AS BIGINT) AS size, md5(string_agg(props, '' ORDER BY event_id)) AS content_md5
       FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
             FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR
                     THEN 0 ELSE 1 END AS opens FROM events))
       GROUP BY user_id, session"""
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    segments = events.select(
        "user_id",
        F.col("event_id").alias("seq"),
        F.encode("props", "UTF-8").alias("bytes"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    sessions = replay(
        spark,
        segments,
        lambda landed: stream_raw_sessions(landed, "user_id", idle="6 hours", watermark=_WHOLE_VIEW),
        "stream_sessions",
        _closing_row(spark, segments, "ts", user_id=-1),
    )
    return sessions.select("user_id", "start", "end", "n", "size", F.md5("content").alias("content_md5"))


@query(
    with_views(
        ARRIVALS,
        """SELECT time_bucket(INTERVAL 1 MINUTE, arrival_ts) AS window_start, count(*) AS n,
             CAST(sum(strlen(piece) // 2 + CASE WHEN counter > 0 THEN 16 ELSE 0 END) AS BIGINT) AS bytes
           FROM arrivals GROUP BY 1""",
    ),
    "stream_throughput",
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = views.arrivals(spark, sf_dir)
    windows = replay(
        spark,
        arrivals,
        lambda landed: stream_throughput(landed, "1 minute", watermark=_WHOLE_VIEW),
        "stream_throughput",
        _closing_row(spark, arrivals, "arrival_ts", header_type=3),
    )
    return windows.select("window_start", "n", "bytes")


@query(with_views(ARRIVALS, "SELECT DISTINCT flow_id, counter FROM arrivals"), "stream_dedupe")
def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = views.arrivals(spark, sf_dir)
    distinct = replay(spark, arrivals, lambda landed: stream_dedupe(landed, _WHOLE_VIEW), "stream_dedupe")
    return distinct.select("flow_id", "counter")


@query(
    with_views(
        FLOWS,
        """SELECT flow_id, size, md5(text) AS content_md5,
             '{' || array_to_string(list_transform(list_filter(entries, lambda e: e.k IN ('big', 'lang', 'note', 'source')),
               lambda e: '"' || e.k || '":"' || e.v || '"'), ',') || '}' AS header_json FROM flows""",
    ),
    "transfer_stream",
)
def transferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_dir(spark, "transfer")
    views.flows(spark, sf_dir).write.parquet(f"{base}/in")
    transfer_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", include_core=False).awaitTermination()
    copied = encode_attributes(spark.read.parquet(f"{base}/out"))
    return copied.select("flow_id", "size", F.md5("content").alias("content_md5"), "header_json")
