"""Mixing sources to target weights.

Words of a source, document after document, are packed into blocks of ``block`` words. The mix is a row of slots, one
block each, in output shards.

* A shard's counts of sources are a multinomial draw: each of its slots draws a source by its weight in the plan.
* A source's counts, summed up shard after shard, are then scaled to its planned total, to whole slots. So every source
  meets its target to a block and none exceeds its cap, and counts vary from shard to shard as drawn; a shard has about
  ``SHARD_SLOTS`` slots.
* The k-th slot of a source takes block ``perm(k mod n)`` of its n blocks, with a permutation of its own for each pass,
  and is joined with the blocks by index. Within a shard, slots lie in a pseudorandom order.

Permutations are swap-or-not networks (Hoang, Morris, Rogaway 2012): arithmetic for any n, without sorting.

Words are ``[^\\x20\\x09-\\x0D]+``. Null or empty texts have size 0 and are taken 0 times; documents without source
form a source of their own, last. Repeated rows are separate documents. Without any words the mix is empty. Totals and
targets are sums over all documents; the window over sources holds one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored
from flowtables.operators.ordered import counter_block, running

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 32
SHARD_SLOTS = 4096
SEED = 20_240_601
#: Each round doubles the places an index can come to; a source is expected to have less than 2 ** 40 blocks.
_ROUNDS = 40
#: What stands for one whole document when parts of documents are summed.
_UNIT = 1 << 32


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of ``i`` in 0..n-1, another for each key; the rounds are one expression."""

    def swapped(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r, n), n) - at, n)
        swap = F.xxhash64(F.greatest(at, partner), *key, -r).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(F.sequence(F.lit(SEED), F.lit(SEED + _ROUNDS - 1)), i, swapped)


def with_targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, n_docs, source_size) with ``source_no`` by code point, null last, and ``target``.

    A target is a weight's share of all sizes, stopped at ``CAP`` times the source's size, the excess reshared by
    weight. In the order of cap / weight a source is capped just if the share per weight that the sources before it
    leave reaches its cap, so one running sum settles all.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    everything = Window.partitionBy()
    by_cap = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * CAP
    return (
        sources.withColumn("source_no", F.row_number().over(by_name).cast("long") - 1)
        .withColumn("weight", F.element_at(weights, (F.col("source_no") % len(WEIGHTS) + 1).cast("int")).cast("double"))
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("caps_before", F.coalesce(F.sum(cap).over(by_cap), F.lit(0)))
        .withColumn("weight_left", F.col("all_weight") - F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)))
        .withColumn("capped", F.col("caps_before") + F.col("ratio") * F.col("weight_left") <= F.col("all_size"))
        .withColumn("capped_size", F.sum(F.when(F.col("capped"), cap).otherwise(0)).over(everything))
        .withColumn("free_weight", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("capped"), cap.cast("double")).otherwise(
                (F.col("all_size") - F.col("capped_size")) * F.col("weight") / F.col("free_weight")
            ),
        )
        .select("source", "source_no", "n_docs", "source_size", "target")
    )


def sized(documents: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))
    return documents.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("content"))


def source_plan(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per source: its target, its blocks, and the slots ``[slot_from, slot_from + n_slots)`` of the dealt order."""
    totals = documents.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    slots = F.when(
        F.col("source_size") > 0,
        F.least(F.round(F.col("target") / F.col("source_size") * F.col("n_blocks")).cast("long"), F.col("n_blocks") * CAP),
    ).otherwise(0)
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    return (
        with_targets(totals)
        .withColumn("n_blocks", n_blocks)
        .withColumn("n_slots", slots.cast("long"))
        .withColumn("slot_from", F.coalesce(F.sum("n_slots").over(before), F.lit(0)))
    )


def placed(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents with ``begin``, the words of their source before them; a source's running sum is cut into salts.

    A source of n documents has about sqrt(n) salts of sqrt(n) documents, so neither the sums over salts nor those
    within a salt gather many rows of a hot source.
    """
    own = documents.join(
        plan.select(F.col("source").alias("_source"), "source_no", "n_docs", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    salts = F.greatest(F.lit(1), F.ceil(F.sqrt("n_docs"))).cast("long")
    own = own.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size", "content"), salts))
    sums = own.groupBy("source_no", "salt").agg(F.sum("size").alias("salt_size"))
    before = Window.partitionBy("source_no").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "salt", F.coalesce(F.sum("salt_size").over(before), F.lit(0)).alias("salt_from"))
    inside = (
        Window.partitionBy("source_no", "salt").orderBy("doc_id", "size", "content").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        own.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(sums, ["source_no", "salt"])
        .withColumn("begin", F.col("salt_from") + F.col("inside"))
        .drop("salt", "salt_from", "inside")
    )


def shard_counts(plan: DataFrame, n_slots: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``shard, source_no, n_blocks, k_from, k_to``: the slots of a source that a shard has, by their number in the source.

    A drawn number's source is looked up by an equi-join on cells of the plan's slots; a source lies in each cell it
    touches. What is summed up over shards is one row per shard and source, in blocks of shards.
    """
    spark = plan.sparkSession
    cells = max(1, n_slots // 1024)
    cell = lambda x: F.floor(x * F.lit(cells).cast("long") / F.lit(n_slots)).cast("long")
    ranges = (
        plan.filter("n_slots > 0")
        .withColumn("slot_to", F.col("slot_from") + F.col("n_slots"))
        .withColumn("cell", F.explode(F.sequence(cell(F.col("slot_from")), cell(F.col("slot_to") - 1))))
        .select("cell", "source_no", "slot_from", "slot_to", "n_slots", "n_blocks")
    )
    slots = spark.range(n_slots).select(F.floor(F.col("id") / shard_slots).cast("long").alias("shard"), "id")
    draws = slots.withColumn("draw", F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(n_slots).cast("long")))
    matched = draws.withColumn("cell", cell(F.col("draw"))).join(ranges, "cell")
    drawn = matched.filter((F.col("draw") >= F.col("slot_from")) & (F.col("draw") < F.col("slot_to")))
    counts = drawn.groupBy("shard", "source_no", "n_slots", "n_blocks").agg(F.count("*").alias("drawn"))
    # A source that no slot drew has its slots in the first shard.
    unseen = plan.filter("n_slots > 0").join(counts.select("source_no").distinct(), "source_no", "left_anti")
    counts = counts.unionByName(
        unseen.select(F.lit(0).cast("long").alias("shard"), "source_no", "n_slots", "n_blocks", F.lit(1).cast("long").alias("drawn"))
    )
    counts = stored(counts, "shard-counts")
    totals = counts.groupBy("source_no").agg(F.sum("drawn").alias("all_drawn"))
    summed = running(
        counts.join(totals, "source_no"), ["source_no"], counter_block("shard"), ["shard"], {"drawn_to": ("sum", F.col("drawn"))}
    )
    # In decimals: slots drawn times slots planned may pass 64 bits.
    scaled = lambda drawn: F.call_function(
        "div", drawn.cast("decimal(19, 0)") * F.col("n_slots").cast("decimal(19, 0)"), F.col("all_drawn").cast("decimal(19, 0)")
    )
    return summed.select(
        "shard",
        "source_no",
        "n_blocks",
        scaled(F.col("drawn_to") - F.col("drawn")).alias("k_from"),
        scaled(F.col("drawn_to")).alias("k_to"),
    ).filter("k_to > k_from")


def deal_slots(plan: DataFrame, n_slots: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``shard, source_no, k, epoch, block_no`` for all slots of the mix."""
    counts = shard_counts(plan, n_slots, shard_slots)
    # Few rows become very many: they are dealt to all tasks before.
    tasks = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = counts.repartition(tasks, "shard", "source_no").withColumn("k", F.explode(F.sequence("k_from", F.col("k_to") - 1)))
    slots = slots.withColumn("epoch", F.call_function("div", "k", "n_blocks"))
    block_no = permuted(F.pmod("k", "n_blocks"), F.col("n_blocks"), F.col("source_no"), F.col("epoch"))
    return slots.select("shard", "source_no", "k", "epoch", block_no.alias("block_no"))


def block_pieces(own: DataFrame, block: int = BLOCK) -> DataFrame:
    """Which words of which documents a block holds: ``source_no, block_no, doc_id, begin, size, n_words``."""
    begin, end = F.col("begin"), F.col("begin") + F.col("size")
    first, last = F.floor(begin / block), F.floor((end - 1) / block)
    low, high = F.greatest(begin, F.col("block_no") * block), F.least(end, (F.col("block_no") + 1) * block)
    return (
        own.filter("size > 0")
        .withColumn("block_no", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
        .withColumn("first_word", low - begin)
        .withColumn("n_words", high - low)
    )


def mix(documents: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The placed documents, and the slots of the mix (see ``deal_slots``)."""
    docs = stored(sized(documents), "sized-documents")
    plan = stored(source_plan(docs, block), "source-plan")
    own = stored(placed(docs, plan), "placed-documents")
    n_slots = plan.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    return own, deal_slots(plan, n_slots) if n_slots else deal_slots(plan, 1).limit(0)


def output_pieces(own: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix itself: for each slot the words it holds, as ranges ``first_word, n_words`` of documents."""
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64("source_no", "k"), "source_no", "k")
    slots = slots.withColumn("slot", F.row_number().over(shuffled).cast("long") - 1)
    return slots.join(block_pieces(own, block), ["source_no", "block_no"]).select(
        "shard", "slot", "doc_id", "content", "first_word", "n_words"
    )


def taken_words(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each document with ``size, source_size, target``, ``taken``, the words the mix takes from it, and ``first_shard``."""
    own, slots = mix(documents, block)
    times = slots.groupBy("source_no", "block_no").agg(F.count("*").alias("times"), F.min("shard").alias("first_shard"))
    # Written, as Spark would take its size for that of the few rows it comes from, and send it to every task.
    times = stored(times, "block-times")
    taken = (
        block_pieces(own, block)
        .join(times, ["source_no", "block_no"])
        .groupBy("source_no", "begin")
        .agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"), F.min("first_shard").alias("first_shard"))
    )
    filled = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0)
    first = F.when(F.col("size") > 0, F.col("first_shard")).alias("first_shard")
    return own.join(taken, ["source_no", "begin"], "left").select("*", filled.cast("long").alias("_taken"), first.alias("_first")).drop(
        "taken", "first_shard"
    ).withColumnsRenamed({"_taken": "taken", "_first": "first_shard"})


def with_copies(taken: DataFrame) -> DataFrame:
    """``taken_words`` of documents with words, with ``copies``: taken / size, rounded up or down so that sums are kept.

    What is over whole copies is summed up, in groups of about sqrt(n) of a source's n documents by size; a document gets
    one copy more where its group's sum, which starts at a pseudorandom place, passes a whole number. So a document's
    expected copies are taken / size, and the words of a group differ from those taken by less than its longest document.
    """
    groups = F.greatest(F.lit(1), F.ceil(F.sqrt("n_docs"))).cast("long")
    div = lambda a, b: F.call_function("div", a, b)
    unit = F.lit(_UNIT)
    before = Window.partitionBy("source_no", "_group").orderBy("size", "begin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.pmod(F.xxhash64("source_no", "_group", F.lit(SEED)), unit)
    return (
        taken.filter("size > 0")
        .withColumn("_group", F.pmod(F.xxhash64("source_no", "begin", F.lit(SEED)), groups))
        .withColumn("_part", div(F.col("taken") % F.col("size") * unit, F.col("size")))
        .withColumn("_from", start + F.coalesce(F.sum("_part").over(before), F.lit(0)))
        .withColumn(
            "copies",
            (div(F.col("taken"), F.col("size")) + div(F.col("_from") + F.col("_part"), unit) - div(F.col("_from"), unit)).cast("int"),
        )
        .drop("_group", "_part", "_from")
    )


def mixed_documents(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``documents`` as the mix has them: whole rows, each in the ``copies`` of ``with_copies``.

    Columns are passed on whatever their names. Rows alike in doc_id, source and text are told apart by their other columns.
    """
    key = ["doc_id", "source", "content"]
    times = (
        with_copies(taken_words(documents, block))
        .filter("copies > 0")
        .select(*key, "copies", F.row_number().over(Window.partitionBy(*key).orderBy("begin")).alias("no"))
    )
    whole = documents.select(F.struct("*").alias("row"), "doc_id", "source", F.xxhash64("text").alias("content"))
    kinds = dict(documents.dtypes)
    order = F.xxhash64(*(F.col("row").getField(c) for c in documents.columns if "map<" not in kinds[c] and "variant" not in kinds[c]))
    numbered = whole.withColumn("no", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    left, right = numbered.alias("l"), times.alias("r")
    match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key] + [F.col("l.no") == F.col("r.no")]
    joined = left.join(right, match).select("l.row", F.explode(F.sequence(F.lit(1), F.col("r.copies"))))
    return joined.select(*(F.col("row").getField(c).alias(c) for c in documents.columns))
