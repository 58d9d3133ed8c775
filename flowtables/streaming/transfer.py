"""The one-way hand-over of flows between two directories."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.attributes import selected_attributes

FLOW_SCHEMA = "flow_id long, attributes map<string,string>, content binary, size long"


def transfer_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files: int = 1000,
    interval: str | None = None,
    **selection,
) -> StreamingQuery:
    """O7. Copy every new flow of a landing directory exactly once, with selected attributes.

    At most ``max_files`` files go per micro-batch, and one micro-batch per ``interval`` caps the rate; without an
    interval the query takes what is there and ends. ``selection`` is that of ``select_attributes``. Exactly-once
    rests on the checkpoint and the file sink's own log.
    """
    landed = spark.readStream.schema(FLOW_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(in_dir)
    chosen = landed.withColumn("attributes", selected_attributes(F.col("attributes"), **selection))
    writer = chosen.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()
