"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowtables.sources.workdir import work_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
