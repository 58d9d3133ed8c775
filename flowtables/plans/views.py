"""Base views of the registered queries, as DataFrames; ``views_sql`` has the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.operators.datagrams import packetize
from flowtables.operators.framed import flows_to_segments
from flowtables.schema import SUCCESS
from flowtables.sources.flows import flows_from_table
from flowtables.sources.workdir import work_dir

DATAGRAM_SIZE = 512
SEGMENT_BYTES = 1000
CONNECTIONS = 50
EPOCH = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. A table of few splits is spread over the cores; a large one is read as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    attributes = {
        "filename": F.concat(F.lit("doc_"), n, F.lit(".txt")),
        "path": F.concat(F.lit("./"), F.col("source"), F.lit("/")),
        "uuid": F.concat(F.lit("u-"), n),
        "mime.type": F.lit("text/plain"),
        "lang": F.col("lang"),
        "source": F.col("source"),
        "priority": F.when(n % 3 == 0, "1"),
        "note": F.when(n % 5 == 0, ""),
        "big": F.when(n % 50 == 7, "x" * 600),
    }
    return flows_from_table(table(spark, sf_dir, "documents"), "doc_id", F.encode("text", "UTF-8"), attributes)


def sent_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with the address of their sender."""
    n = F.col("flow_id")
    sender = F.concat(F.lit("10.0."), n % 4, F.lit("."), n % 200 + 1)
    return flows(spark, sf_dir).withColumn("source", sender)


def short_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flows, without the attribute that makes headers of some too long for a datagram."""
    return sent_flows(spark, sf_dir).withColumn("attributes", F.map_filter("attributes", lambda k, _: k != "big"))


def datagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packetize(short_flows(spark, sf_dir), DATAGRAM_SIZE).filter(F.col("outcome") == SUCCESS).drop("outcome")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The datagrams of all flows behind a lossy network."""
    return network(datagrams(spark, sf_dir))


def network(sent: DataFrame, loses: bool = True) -> DataFrame:
    """What comes of datagrams behind a network that loses (unless told not to), doubles, reorders and delays them."""
    flow, counter = F.col("flow_id"), F.col("counter")
    # The receiver learns n from the first datagram only; here it also places the delayed last piece.
    copies = F.when((flow * 7 + counter * 13) % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = F.when((flow % 20 == 3) & (counter == F.col("n_datagrams") - 1), 3000).otherwise(0)
    ms = (flow % 1000) * 5000 + (counter * 389 + flow) % 1013 + F.col("copy") * 50 + late
    return (
        sent.filter((flow * 31 + counter * 17) % 97 != 0 if loses else F.lit(True))
        .withColumn("copy", F.explode(copies))
        .withColumn("arrival_ms", ms.cast("bigint"))
        .withColumn("arrival_seq", F.col("arrival_ms") * 10 + F.col("copy"))
        .withColumn("arrival_ts", F.timestamp_millis(F.unix_millis(F.lit(EPOCH).cast("timestamp")) + F.col("arrival_ms")))
        .withColumn("n_datagrams", F.when(counter == 0, F.col("n_datagrams")))
        .drop("copy")
    )


def connected_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).withColumn("conn_id", F.col("flow_id") % CONNECTIONS)


def framed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_to_segments(connected_flows(spark, sf_dir), segment_bytes=SEGMENT_BYTES)


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table, as a receiver would find it."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def truncated_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth connection closes after nine tenths of its bytes."""
    segments = framed_segments(spark, sf_dir)
    totals = segments.groupBy("conn_id").agg(F.max(F.col("offset") + F.octet_length("bytes")).alias("total"))
    limit = F.when(F.col("conn_id") % 10 == 3, F.floor(F.col("total") * 9 / 10)).otherwise(F.col("total"))
    left = F.least(limit - F.col("offset"), F.octet_length("bytes"))
    return (
        segments.join(F.broadcast(totals), "conn_id")
        .filter(left > 0)
        .withColumn("bytes", F.substring("bytes", F.lit(1), left.cast("int")))
        .drop("total")
    )


def raw_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", F.col("turn").alias("seq"), F.encode("text", "UTF-8").alias("bytes")
    )


def event_address() -> Column:
    user, event = F.col("user_id"), F.col("event_id")
    return F.concat(F.lit("10."), user % 4, F.lit("."), event % 256, F.lit("."), user % 256)


ALLOWLIST = "10.1.0.0/16,10.2.64.0/18,10.3.5.7,192.168.0.0/24"
LISTED = "lang, priority ,note,absent"
PATTERN = "(so|la).*|uuid"
