"""Senders, connections and the transfer log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions import addresses
from flowtables.functions.times import epoch_micros
from flowtables.operators.ordered import RANGE_BLOCK, range_blocks, running, time_block
from flowtables.schema import check_port


def ip_allowlist_filter(
    df: DataFrame, ip_col: str, allowlist: str | None, rejected: bool = False, compat: bool = False
) -> DataFrame:
    """O15. Rows whose IPv4 address is listed or lies in a listed CIDR block; ``rejected=True`` gives the others.

    The list is an argument, so the test is a plain filter and can run before any shuffle. No list admits all.
    """
    if allowlist is None:
        return df.filter(F.lit(False)) if rejected else df
    parse = addresses.parse_allowlist_compat if compat else addresses.parse_allowlist
    ranges, exact = parse(allowlist)
    admitted = addresses.in_ranges(addresses.ipv4_number(F.col(ip_col)), ranges)
    if exact:
        admitted = admitted | F.coalesce(F.col(ip_col).isin(exact), F.lit(False))
    return df.filter(~admitted if rejected else admitted)


def address_blocks(blocks: DataFrame, entry: str = "entry") -> DataFrame:
    """``length, network, admits, valid_from, valid_to`` of a table of CIDR blocks and plain addresses.

    ``admits``, ``valid_from`` and ``valid_to`` (exclusive) are taken from columns of these names; without them a block
    admits and holds for ever. An entry that is neither a block nor an address fails the query.
    """
    parts = F.split(F.trim(entry), "/")
    length = F.when(F.size(parts) == 1, 32).otherwise(F.when(parts[1].rlike(r"\A\d{1,2}\z"), parts[1].cast("int")))
    number = F.when(F.size(parts) <= 2, addresses.ipv4_number(parts[0]))
    wrong = F.raise_error(F.concat(F.lit("not an IPv4 block: "), F.coalesce(F.col(entry), F.lit("null")))).cast("int")
    length = F.when(number.isNotNull() & length.between(0, 32), length).otherwise(wrong)

    def given(name: str, kind: str, default: object) -> Column:
        return F.coalesce(F.col(name) if name in blocks.columns else F.lit(None), F.lit(default)).cast(kind).alias(name)

    return blocks.select(
        length.alias("length"),
        number.alias("number"),
        given("admits", "boolean", True),
        given("valid_from", "timestamp", None),
        given("valid_to", "timestamp", None),
    ).select("length", F.call_function("div", F.col("number"), _block_size(F.col("length"))).alias("network"), "admits", "valid_from", "valid_to")


def _block_size(length: Column) -> Column:
    return F.pow(F.lit(2), F.lit(32) - length).cast("bigint")


def ip_table_filter(
    df: DataFrame, ip_col: str, blocks: DataFrame, at: str | None = None, entry: str = "entry", rejected: bool = False
) -> DataFrame:
    """O15 with the list as a table of any length (see :func:`address_blocks`); ``rejected=True`` gives the other rows.

    Of the blocks that hold an address and, with ``at``, are valid at the row's time, the longest decides; among equally
    long ones a rejecting one does. Addresses that no block holds, and what is no address, are rejected.

    Each distinct address probes the lengths that occur (33 at most) by an equi-join. What it finds, a few rules, is joined
    back to its rows, so that rows are shuffled once and never multiplied.
    """
    table = address_blocks(blocks, entry)
    # At most 33 numbers.
    lengths = sorted(r["length"] for r in table.select("length").distinct().collect())
    rows = df.select(F.struct("*").alias("row"), addresses.ipv4_number(F.col(ip_col)).alias("number"))
    known = rows.filter(F.col("number").isNotNull()).select("number").distinct()
    probes = known.select("number", F.explode(F.array(*(F.lit(n) for n in lengths))).alias("length") if lengths else F.lit(0).alias("length"))
    probes = probes.withColumn("network", F.call_function("div", F.col("number"), _block_size(F.col("length"))))
    rule = F.struct((-F.col("length")).alias("rank"), "admits", "valid_from", "valid_to")
    rules = probes.join(table, ["length", "network"]).groupBy("number").agg(F.sort_array(F.collect_set(rule)).alias("rules"))
    rules = rules.withColumnRenamed("number", "_number")
    joined = rows.join(rules, F.col("number") == F.col("_number"), "left")
    valid = F.col("rules")
    if at is not None:
        moment = F.col("row").getField(at)
        valid = F.filter(
            valid,
            lambda r: (r["valid_from"].isNull() | (r["valid_from"] <= moment)) & (r["valid_to"].isNull() | (moment < r["valid_to"])),
        )
    admitted = F.coalesce(F.get(valid, F.lit(0))["admits"], F.lit(False))
    return joined.filter(~admitted if rejected else admitted).select(*(F.col("row").getField(c).alias(c) for c in df.columns))


def transfer_log(
    flows: DataFrame, host: Column | str, port: int, elapsed_ms: Column | str, size: Column | str, scheme: str = "tcp"
) -> DataFrame:
    """O23. One provenance row per flow: ``transit_uri``, ``bytes``, ``elapsed_ms`` and the columns of ``flows``."""
    check_port(port)

    def value(v) -> Column:
        return v if isinstance(v, Column) else F.col(v)

    return flows.withColumns(
        {
            "transit_uri": F.concat(F.lit(f"{scheme}://"), value(host), F.lit(f":{port}")),
            "bytes": value(size).cast("bigint"),
            "elapsed_ms": value(elapsed_ms),
        }
    )


def transfer_log_summary(log: DataFrame) -> DataFrame:
    """Flows, bytes and time per transit URI."""
    return log.groupBy("transit_uri").agg(
        F.count("*").alias("flows"), F.sum("bytes").alias("bytes"), F.sum("elapsed_ms").alias("elapsed_ms")
    )


def assign_flow_ids(
    flows: DataFrame,
    sender: str,
    order: str,
    epoch: Column | None = None,
    tie_break: Sequence[str] = (),
    block_seconds: int | None = 3600,
    name: str = "flow_no",
) -> DataFrame:
    """O29. Number each sender's flows 1, 2, 3 ... by the timestamp ``order``, again from 1 in every ``epoch``.

    ``block_seconds`` is the stretch of time numbered in one task; make it smaller for busier senders. With None, blocks
    are measured (``range_blocks``), which costs a written copy: a sender may then have any number of flows at one time.
    """
    own = flows.withColumn("_epoch", F.lit(0) if epoch is None else epoch)
    if block_seconds is None:
        own, block = range_blocks(own, [sender, "_epoch"], [order, *tie_break]), F.col(RANGE_BLOCK)
    else:
        block = time_block(flows, order, block_seconds)
    numbered = running(own, [sender, "_epoch"], block, [order, *tie_break], {name: ("sum", F.lit(1))})
    return numbered.select(*flows.columns, name)


def assign_connections(
    flows: DataFrame,
    dest: str,
    order: str,
    idle_seconds: float = 5.0,
    per_flow: bool = False,
    tie_break: Sequence[str] = (),
    block_seconds: int | None = 3600,
) -> DataFrame:
    """O30. Add ``conn_no``: the connection to ``dest`` that carries each flow.

    With ``per_flow`` every flow has its own. Otherwise one is reused until it has been idle for longer than
    ``idle_seconds``. Like :func:`running`, windows cover a stretch of time, not a whole destination; ``block_seconds`` as in
    :func:`assign_flow_ids`.
    """
    if per_flow:
        return assign_flow_ids(flows, dest, order, None, tie_break, block_seconds, "conn_no")
    idle = int(idle_seconds * 1_000_000)
    if block_seconds is None:
        blocked = range_blocks(flows, [dest], [order, *tie_break]).withColumnRenamed(RANGE_BLOCK, "_block")
    else:
        blocked = flows.withColumn("_block", time_block(flows, order, block_seconds))
    blocked = blocked.withColumn("_at", epoch_micros(flows, order))
    cells = [dest, "_block"]
    within = Window.partitionBy(*cells).orderBy(order, *tie_break)
    opened = blocked.withColumn("_opens", (F.col("_at") - F.lag("_at").over(within) > idle).cast("int"))

    earlier = Window.partitionBy(dest).orderBy("_block")
    blocks = opened.groupBy(*cells).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.coalesce(F.sum("_opens"), F.lit(0)).alias("_inner")
    )
    blocks = blocks.withColumn(
        "_edge", F.coalesce((F.col("_first") - F.lag("_last").over(earlier) > idle).cast("int"), F.lit(1))
    )
    before = F.sum(F.col("_inner") + F.col("_edge")).over(earlier.rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.select(*cells, (before - F.col("_inner")).alias("_before"))

    local = F.sum(F.coalesce("_opens", F.lit(0))).over(within.rowsBetween(Window.unboundedPreceding, 0))
    return opened.join(blocks, cells).withColumn("conn_no", F.col("_before") + local).select(*flows.columns, "conn_no")
