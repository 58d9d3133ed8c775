"""A corpus pipeline: toxic documents go, boilerplate lines go, near copies go, sources are mixed, the rest is packed.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm import linededup, mixing, ngramjoin, packing, toxicity
from flowtables.llm.scratch import stored

#: Near copies share at least so many percent of their distinct shingles of so many words.
NEAR_PERCENT = 80
NEAR_WORDS = 5
#: Arrow batches of texts lie several times in a task's JVM and in its Python worker: by default, 10,000 rows in each.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def small_batches(stage):
    """``stage`` with ``BATCHES``, unless the session sets its own. They stay set: results are computed after it returns."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, most in BATCHES.items():
            if spark.conf.get(name, most) == most:  # not set
                spark.conf.set(name, most)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@small_batches
def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(docs, counts=False)


@small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.one_of_each(docs, percent=NEAR_PERCENT, size=NEAR_WORDS)


@small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


@small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and pseudorandom permutations have no SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
