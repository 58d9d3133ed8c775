"""Flows from tables and files; outcome sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def flows_from_table(
    df: DataFrame, flow_id: str, content: Column, attributes: Mapping[str, Column] | Column
) -> DataFrame:
    """O1. ``flow_id, attributes, content, size`` from any table. Attributes whose value is null are absent."""
    if not isinstance(attributes, Column):
        pairs = [c for name, value in attributes.items() for c in (F.lit(name), value.cast("string"))]
        attributes = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return df.select(
        F.col(flow_id).alias("flow_id"),
        attributes.alias("attributes"),
        content.cast("binary").alias("content"),
        F.octet_length(content).cast("bigint").alias("size"),
    )


def read_flows(spark: SparkSession, path: str, glob: str = "*", include_empty: bool = True) -> DataFrame:
    """O1. One flow per file, with ``filename`` and ``path`` attributes; the flow id is a hash of the full path.

    Spark's file scan skips empty files; ``include_empty`` adds them from the file list it keeps on the driver anyway.
    """
    scanned = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    )
    files = scanned.select("path", "content", "length")
    if include_empty:
        files = files.unionByName(_empty_files(spark, scanned))
    return files.select(
        F.xxhash64("path").alias("flow_id"),
        F.create_map(
            F.lit("filename"),
            F.regexp_extract("path", r"([^/]*)$", 1),
            F.lit("path"),
            F.regexp_replace("path", r"[^/]*$", ""),
        ).alias("attributes"),
        "content",
        F.col("length").alias("size"),
    )


def _empty_files(spark: SparkSession, scanned: DataFrame) -> DataFrame:
    def one_slash(uri: Column) -> Column:
        return F.regexp_replace(uri, "^file:/+", "file:/")

    listed = spark.createDataFrame([(f,) for f in scanned.inputFiles()], "uri string").select(one_slash(F.col("uri")).alias("uri"))
    with_content = scanned.select(one_slash(F.col("_metadata.file_path")).alias("uri"))
    return listed.join(with_content, "uri", "left_anti").select(
        F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))).alias("path"),
        F.unhex(F.lit("")).alias("content"),
        F.lit(0).cast("bigint").alias("length"),
    )


def write_outcomes(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """O6. Store success, failure and error rows apart, one directory per outcome."""
    df.write.mode(mode).partitionBy("outcome").parquet(path)


def stream_outcomes(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """O6 for a stream: the same layout, each row exactly once. ``trigger`` is that of ``writeStream``."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy("outcome").outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
