"""Running computations over long ordered groups.

A plain ``Window.partitionBy(group).orderBy(x)`` sends a whole group to one task. Here each group
is cut into blocks of neighbouring rows by a number that rises with the order. Rows are windowed
within (group, block) only; what earlier blocks contribute is worked out on one row per block and
joined back. The widest task then holds one block of rows, or one row per block.

Blocks are stretches of counters or times. Where a stretch may hold any number of rows (all of a sender's flows in one
second, hashed numbers), ``range_blocks`` measures them: Spark samples splitters of the order and deals rows by range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions.times import epoch_micros
from flowtables.schema import COUNTER_BLOCK
from flowtables.sources.workdir import work_dir

_COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}


def counter_block(counter: Column | str = "counter", size: int = COUNTER_BLOCK) -> Column:
    counter = F.col(counter) if isinstance(counter, str) else counter
    return _block_of(counter.cast("bigint"), size)


def time_block(df: DataFrame, ts: str, seconds: int) -> Column:
    return _block_of(epoch_micros(df, ts), seconds * 1_000_000)


def _block_of(number: Column, size: int) -> Column:
    # Never null, so that no null check on it keeps two readers of a shuffle from sharing it.
    return F.coalesce(F.call_function("div", number, F.lit(size).cast("bigint")), F.lit(0).cast("bigint"))


#: The column ``range_blocks`` adds.
RANGE_BLOCK = "_range"


def range_blocks(df: DataFrame, group: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` written in ranges of group and order, with the number of its range: about equally many rows in each.

    Rows alike in both are told apart by a hash of all columns, so that even they can lie in several ranges.
    """
    spark = df.sparkSession
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *group, *order, F.xxhash64(*hashed))
    ranged = ranged.withColumn(RANGE_BLOCK, F.spark_partition_id().cast("bigint"))
    path = work_dir(spark, "ranges")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running(
    df: DataFrame,
    group: Sequence[str],
    block: Column,
    order: Sequence[Column | str],
    values: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add running values, current row included.

    ``values`` maps an output column to ``(kind, column)`` with kind ``sum``, ``max`` or ``min``.
    ``block`` must never fall while ``order`` rises within a group. Group columns must not be null.
    """
    blocked = df.withColumn("_block", block)
    for name, (_, column) in values.items():
        blocked = blocked.withColumn(f"_in_{name}", column)
    cells = [*group, "_block"]

    totals = blocked.groupBy(*cells).agg(
        *(_COMBINE[kind](f"_in_{name}").alias(f"_of_{name}") for name, (kind, _) in values.items())
    )
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *cells, *(_COMBINE[kind](f"_of_{name}").over(earlier).alias(f"_before_{name}") for name, (kind, _) in values.items())
    )

    within = Window.partitionBy(*cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = blocked.join(carried, cells)
    for name, (kind, _) in values.items():
        local = _COMBINE[kind](f"_in_{name}").over(within)
        before = F.col(f"_before_{name}")
        if kind == "sum":
            total = local + F.coalesce(before, F.lit(0))
        else:
            total = (F.greatest if kind == "max" else F.least)(local, before)
        joined = joined.withColumn(name, total)
    return joined.select(*df.columns, *values)
