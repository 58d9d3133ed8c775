"""Running a stream over a landed table to its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.sources.workdir import work_dir
from flowtables.streaming.settings import prepare

#: Files of a micro-batch: at least so many, and one for so many rows up to one per core.
_FILES_PER_BATCH = 2
_ROWS_PER_FILE = 1000


def replay(
    spark: SparkSession,
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    name: str,
    closing_row: DataFrame | None = None,
    max_files: int = 1000,
    batch: Column | None = None,
) -> DataFrame:
    """Land ``rows`` as files, stream them through ``transform`` into a table and read that.

    With ``batch`` (a number of each row) rows come in as many micro-batches, in order: all batches are landed as equally
    many files, by the rows of the smallest. ``closing_row`` is landed last: a row far in the future that moves the
    watermark past everything else.
    """
    prepare(spark)
    base = work_dir(spark, name)
    if batch is None:
        rows.write.parquet(f"{base}/in")
    else:
        rows.withColumn("_batch", batch.cast("int")).write.partitionBy("_batch").parquet(f"{base}/all")
        schema = T.StructType([*rows.schema.fields, T.StructField("_batch", T.IntegerType())])
        landed = spark.read.schema(schema).parquet(f"{base}/all")
        counts = {r["_batch"]: r["count"] for r in landed.groupBy("_batch").count().collect()}
        fit = min(spark.sparkContext.defaultParallelism, min(counts.values(), default=0) // _ROWS_PER_FILE)
        max_files = max(_FILES_PER_BATCH, fit)
        for number in sorted(counts):
            own = landed.filter(F.col("_batch") == number).select(*rows.columns)
            own.repartition(max_files).write.mode("append").parquet(f"{base}/in")
    if closing_row is not None:
        closing_row.select(*rows.columns).write.mode("append").parquet(f"{base}/in")
    landed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max_files).parquet(f"{base}/in")
    out = transform(landed)
    query = (
        out.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")
