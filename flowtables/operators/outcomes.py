"""What became of each flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.functions import binary

MATCH = "match"
MISMATCH = "error"

#: Bytes of a leaf of a hash tree, how many digests a node takes, and the levels above the leaves: up to 64 TiB a flow.
LEAF_BYTES = 64 * 1024
FAN = 1024
LEVELS = 3


def verify_checksums(
    received: DataFrame, expected: DataFrame, key: str = "flow_id", content: str = "content", md5: str = "md5"
) -> DataFrame:
    """O16. ``status`` of each expected flow: ``match`` if it was received with the recorded md5, else ``error``.

    Contents are hashed where they lie; only (key, md5) pairs are shuffled, copies merged beforehand.
    """
    sums = received.select(key, F.md5(content).alias(md5)).distinct().withColumn("_found", F.lit(True))
    status = F.when(F.col("_found"), MATCH).otherwise(MISMATCH)
    return expected.join(sums, [key, md5], "left").withColumn("status", status).drop("_found")


def tree_checksums(
    parts: DataFrame, key: str = "flow_id", offset: str = "offset", content: str = "content",
    leaf_bytes: int = LEAF_BYTES, fan: int = FAN, levels: int = LEVELS,
) -> DataFrame:
    """``key, tree_md5``: a checksum of flows of any size that is the same however they are cut into parts.

    It is the root of a hash tree over leaves of ``leaf_bytes`` bytes: each level hashes up to ``fan`` digests of the one
    below. Leaves that lie within a part are hashed there; only leaves that parts share are put together after a shuffle.
    Parts may come twice. A flow of no bytes has one empty part.
    """
    size = F.octet_length(content).cast("bigint")
    leaf = F.lit(leaf_bytes).cast("bigint")
    div = lambda a, b: F.call_function("div", a, b)
    first, last = div(F.col(offset), leaf), div(F.col(offset) + F.greatest(size, F.lit(1)) - 1, leaf)
    begin = F.greatest(F.col("at"), F.col("leaf") * leaf)
    end = F.least(F.col("at") + F.octet_length("bytes"), (F.col("leaf") + 1) * leaf)
    cut = parts.select(
        key, F.col(offset).cast("bigint").alias("at"), F.col(content).alias("bytes"), F.explode(F.sequence(first, last)).alias("leaf")
    ).select(key, "leaf", begin.alias("begin"), binary.slice_bytes(F.col("bytes"), begin - F.col("at"), end - begin).alias("piece"))
    whole = F.octet_length("piece") == leaf_bytes
    pieces = cut.select(
        key, "leaf", "begin", F.when(whole, F.unhex(F.md5("piece"))).alias("digest"), F.when(~whole, F.col("piece")).alias("piece")
    ).dropDuplicates([key, "leaf", "begin"])
    nodes = pieces.groupBy(key, "leaf").agg(
        F.first("digest", ignorenulls=True).alias("digest"), F.expr("listagg(piece) within group (order by begin)").alias("piece")
    )
    nodes = nodes.select(key, F.col("leaf").alias("node"), F.coalesce("digest", F.unhex(F.md5("piece"))).alias("digest"))
    for _ in range(levels):
        above = nodes.withColumn("above", div(F.col("node"), F.lit(fan).cast("bigint"))).groupBy(key, "above")
        nodes = above.agg(F.expr("unhex(md5(listagg(digest) within group (order by node)))").alias("digest"))
        nodes = nodes.withColumnRenamed("above", "node")
    return nodes.select(key, F.lower(F.hex("digest")).alias("tree_md5"))


def verify_checksums_parts(
    received: DataFrame, expected: DataFrame, key: str = "flow_id", offset: str = "offset", content: str = "content", **tree: int
) -> DataFrame:
    """O16 for flows in parts: ``status`` of each expected flow (``key, tree_md5`` of :func:`tree_checksums`)."""
    sums = tree_checksums(received, key, offset, content, **tree).withColumn("_found", F.lit(True))
    status = F.when(F.col("_found"), MATCH).otherwise(MISMATCH)
    return expected.join(sums, [key, "tree_md5"], "left").withColumn("status", status).drop("_found")


def outcome_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """O22. Number of flows per outcome."""
    return df.groupBy(outcome).agg(F.count("*").alias("n"))
