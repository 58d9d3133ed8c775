"""N-gram Jaccard join: documents that share at least ``percent`` of their distinct word shingles, and their classes.

Documents with equal sets form a class; the join runs between classes. Sets are ordered rare first, by counts of all
shingles of all documents (in a count table of fixed size, so that it can go to every task). Two sets that are similar
enough share a shingle of their prefixes, so classes meet on prefix shingles only, pass length, positional and suffix
filters, and each pair is verified once on the whole texts.

Not all pairs of a group are made. In star rounds every class that shares a prefix shingle is compared with one centre of
it; classes that are already in one component are not compared at all. After them, what is left (classes of *different*
components that share a prefix shingle) is compared in full, so no component misses a link.

Words are runs of bytes other than white space, A-Z lower-cased. A text of one to three words has one shingle, its whole
sequence; without words, or null, a text has none and is linked with nothing. Repeated rows are in one class. Rows
without doc_id take part, but only as members (a component is named by its smallest doc_id). An empty table gives no
rows; extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.components import components
from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import LOWER, SMALL_SLICE_BYTES, WORD, Hasher, mapped, mixed, owners, runs, sliced, texts, windows

SHINGLE = 4
PERCENT = 85
#: Counters of the table that orders shingles; a power of two.
COUNTERS = 1 << 22
_CHUNK = 1 << 16
#: So many classes a task remembers as given; beyond it forgets them all, and some are given twice.
GIVEN_CLASSES = 1 << 17
#: Shingles counted more often are dealt into so many parts. All their rows stay, lone or not.
COMMON_COUNT = 1 << 14
COMMON_PARTS = 1 << 10
STAR_ROUNDS = 2
#: Classes of a block when the links of a component are counted, and shingles compared at once.
LINK_BLOCK = 256
_LINK_COLUMNS = 4096
#: Parts the suffix filter compares: those of the hashes' first four bits.
_PIVOTS = 16


def shingle_sets(data: np.ndarray, borders: np.ndarray, hasher: Hasher, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and where each text's begin."""
    starts, ends, first = runs(data, borders, WORD)
    hashes = hasher.of_bytes(LOWER[data], starts, ends)
    doc = owners(first)
    all_windows = windows(hashes, size)
    inside = np.flatnonzero(doc[: len(all_windows)] == doc[size - 1 :]) if len(all_windows) else np.zeros(0, np.int64)
    n_words = np.diff(first)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    whole = hasher.ranges(hashes, first[short], first[short + 1])
    keys = np.concatenate((all_windows[inside], whole))
    of = np.concatenate((doc[inside], short))
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    keys, of = keys[new], of[new]
    return keys, np.searchsorted(of, np.arange(len(first)))


def shingle_counts(documents: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """How many documents hold a shingle of each counter: all shingles of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts, waiting, n_waiting = Hasher(), np.zeros(COUNTERS, np.uint32), [], 0

        def settle() -> None:
            np.add(counts, np.bincount(np.concatenate(waiting), minlength=COUNTERS), out=counts, casting="unsafe")
            waiting.clear()

        for _, data, borders in sliced(batches, "text", SMALL_SLICE_BYTES):
            keys, _ = shingle_sets(data, borders, hasher, size)
            waiting.append((keys & np.uint64(COUNTERS - 1)).astype(np.int32))
            n_waiting += len(keys)
            if n_waiting > COUNTERS:
                settle()
                n_waiting = 0
        if waiting:
            settle()
        if counts.any():
            for part, low in enumerate(range(0, COUNTERS, _CHUNK)):
                own = zlib.compress(counts[low : low + _CHUNK].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "counts": pa.array([own], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                planes = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8).reshape(4, -1)
                own = np.ascontiguousarray(planes.T).view("<u4").ravel()
                total[part] = total.get(part, 0) + own.astype(np.int64)
        for part, counts in total.items():
            own = pa.array([counts.astype("<f4").tobytes()], pa.binary())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "counts": own})

    schema = "part int, counts binary"
    n_parts = COUNTERS // _CHUNK
    rows = documents.select("text").mapInArrow(count, schema).repartition(n_parts, "part").mapInArrow(add, schema)
    out = np.zeros(COUNTERS, np.float32)
    for row in rows.collect():  # of fixed size
        out[row["part"] * _CHUNK : (row["part"] + 1) * _CHUNK] = np.frombuffer(row["counts"], "<f4")
    return out


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Of n shingles in order, how many must be looked at: n - ceil(percent/100 n) + 1."""
    return n - -(-percent * n // 100) + 1


def prefix_rows(documents: DataFrame, counts, percent: int, size: int) -> DataFrame:
    """``shingle, class, n, at``: each set's prefix in rare-first order; ``part`` is above 0 for common shingles."""

    def run(batch, data, borders, state):
        keys, first = shingle_sets(data, borders, state["hasher"], size)
        n = np.diff(first)
        doc = owners(first)
        found = counts.value[(keys & np.uint64(COUNTERS - 1)).astype(np.int64)]
        order = np.lexsort((keys, found, doc))
        at = np.arange(len(keys)) - first[:-1][doc]
        # Copies add nothing: a task gives each of its sets once.
        classes = set_hashes(keys, first, state["hasher"]).view(np.int64)
        given = state.setdefault("given", set())
        if len(given) > GIVEN_CLASSES:
            given.clear()
        new = np.zeros(len(n), bool)
        for i, c in enumerate(classes.tolist()):
            if c not in given:
                given.add(c)
                new[i] = True
        chosen = (at < prefix_length(n, percent)[doc]) & new[doc]
        own = classes[doc[chosen]]
        common = found[order][chosen] > COMMON_COUNT
        return {
            "shingle": pa.array(keys[order][chosen].view(np.int64)),
            "class": pa.array(own),
            "n": pa.array(n[doc[chosen]], pa.int64()),
            "at": pa.array(at[chosen], pa.int64()),
            "part": pa.array(np.where(common, 1 + own % COMMON_PARTS, 0).astype(np.int32)),
        }

    schema = "shingle long, class long, n long, at long, part int"
    return mapped(documents.select("text"), run, "text", schema, SMALL_SLICE_BYTES)


def set_hashes(keys: np.ndarray, first: np.ndarray, hasher: Hasher) -> np.ndarray:
    """A hash of each whole set."""
    return hasher.ranges(mixed(keys), first[:-1], first[1:])


def class_members(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, class`` of every document; documents without shingles have no class."""

    def run(batch, data, borders, state):
        keys, first = shingle_sets(data, borders, state["hasher"], size)
        n = np.diff(first)
        return {
            "doc_id": batch.column(0),
            "n": pa.array(n, pa.int64()),
            "class": pa.array(set_hashes(keys, first, state["hasher"]).view(np.int64), mask=n == 0),
        }

    return mapped(documents.select(F.col("doc_id").cast("long"), "text"), run, "text", "doc_id long, n long, class long", SMALL_SLICE_BYTES)


def verified(pairs: DataFrame, class_texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs ``a, b`` of classes whose sets are similar enough, by their whole texts."""
    one = class_texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    two = class_texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "text_a", SMALL_SLICE_BYTES):
            other, other_borders = texts(batch.column(3))
            x, x_first = shingle_sets(data, borders, hasher, size)
            y, y_first = shingle_sets(other, other_borders, hasher, size)
            n, m = np.diff(x_first), np.diff(y_first)
            shared = np.zeros(len(n), np.int64)
            for i in np.flatnonzero(_suffix_filter(x, x_first, y, y_first, percent)).tolist():
                own, others = x[x_first[i] : x_first[i + 1]], y[y_first[i] : y_first[i + 1]]
                shared[i] = len(np.intersect1d(own, others, assume_unique=True))
            union = n + m - shared
            yield batch.select(["a", "b"]).filter(pa.array((100 * shared >= percent * union) & (shared > 0)))

    joined = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    # Rows that share a doc_id give a class several texts.
    return joined.mapInArrow(run, "a long, b long").distinct()


def _suffix_filter(x, x_first, y, y_first, percent: int) -> np.ndarray:
    """Pairs of sets whose parts between fixed pivots differ in size by no more than similar sets may differ."""

    def parts(keys, first):
        at = owners(first) * _PIVOTS + (keys >> np.uint64(64 - 4)).astype(np.int64)
        return np.bincount(at, minlength=(len(first) - 1) * _PIVOTS).reshape(-1, _PIVOTS)

    n, m = np.diff(x_first), np.diff(y_first)
    needed = -(-(n + m) * percent // (100 + percent))
    return np.abs(parts(x, x_first) - parts(y, y_first)).sum(1) <= n + m - 2 * needed


def _could_link(n, at, other_n, other_at, percent: int):
    """Length and positional filters: the most two sets can share beyond a shingle at these places."""
    fits = (100 * F.least(n, other_n)) >= (percent * F.greatest(n, other_n))
    most = F.least(n - at, other_n - other_at)
    # Nothing before the first shared shingle is shared, so the first one's bound holds for the pair.
    needed = F.ceil((n + other_n) * percent / F.lit(100.0 + percent) - 1e-9)
    return fits, most >= needed


def _candidate_pairs(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a, b`` of classes that meet on a shingle and pass the filters.

    The positional bound holds at the first shingle two prefixes share; at later ones it is only tighter than it may be,
    so a pair is judged by its loosest meeting.
    """
    met = left.join(right, "shingle").filter(F.col("component") != F.col("other_component"))
    fits, place = _could_link(F.col("n"), F.col("at"), F.col("other_n"), F.col("other_at"), percent)
    return (
        met.filter(fits & place)
        .select(F.least("class", "other_class").alias("a"), F.greatest("class", "other_class").alias("b"))
        .distinct()
    )


def similarity_classes(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE, count_links: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id`` and ``n_links`` per document: with how many other sets its own set is linked.

    Components need few of the links; without ``count_links`` only those made for them are counted.
    """
    spark = documents.sparkSession
    own = documents.select(F.col("doc_id").cast("long"), "text")
    members = stored(class_members(own, size), "class-members")
    counts = spark.sparkContext.broadcast(shingle_counts(own, size))
    # Prefixes are large and all but a few go at once, so they are made and shuffled once and never written. A shingle of
    # one class links nothing. One found twice may still be of one class, given by two tasks.
    found = F.count("*").over(Window.partitionBy("shingle", "part"))
    shared = prefix_rows(own, counts, percent, size).withColumn("found", found).filter("found > 1 OR part > 0")
    shared = stored(shared.select("shingle", "class", "n", "at"), "shared-prefixes")
    # One text of each class that meets another.
    meeting = members.join(shared.select("class").distinct(), "class", "left_semi")
    chosen = meeting.groupBy("class").agg(F.min("doc_id").alias("_doc_id"))
    sources = own.join(chosen, F.col("doc_id").eqNullSafe(F.col("_doc_id"))).select("class", "text")
    class_texts = all_texts = stored(_own_texts(sources, size), "class-texts")

    links, seen, labels = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        known = _labelled(shared, labels)
        mixed_shingles = known.groupBy("shingle").agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            # The first centre is a set with the fewest rarer shingles, which is nearest to what a group shares; the
            # next ones are picked at random.
            F.min(F.struct((F.col("at") if turn == 0 else F.xxhash64("class", F.lit(turn))).alias("key"), "class", "n", "at", "component")).alias("c"),
        ).filter("low != high")
        if turn > 0:
            mixed_shingles = stored(mixed_shingles, "mixed-shingles")
            if mixed_shingles.isEmpty():  # no two components share a shingle any more
                break
        if turn == 1:
            # Most classes are in their component by now; only the others can still be compared.
            left = known.join(mixed_shingles.select("shingle"), "shingle", "left_semi").select("class").distinct()
            class_texts = stored(class_texts.join(left, "class", "left_semi"), "class-texts")
        last = turn == STAR_ROUNDS
        if not last:
            others = mixed_shingles.select(
                "shingle",
                *(F.col(f"c.{k}").alias(f"other_{k}") for k in ("class", "n", "at", "component")),
            )
            pairs = stored(_not_in(_candidate_pairs(known, others, percent), seen), "candidate-pairs")
            # Centres that have no new pairs say nothing of the other classes.
            last = turn > 0 and pairs.isEmpty()
        if last:
            left = known.join(mixed_shingles.select("shingle"), "shingle", "left_semi")
            pairs = stored(_not_in(_cross_pairs(left, percent), seen), "candidate-pairs")
        seen = pairs if seen is None else seen.unionByName(pairs)
        found = stored(verified(pairs, class_texts, percent, size), "verified-pairs")
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            break
    both = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class")))
    n_links = both.groupBy("class").agg(F.count("*").alias("n_links"))
    if count_links:
        n_links = _all_links(links, labels, n_links, all_texts, percent, size)
    return _members_named(members, n_links, labels)


def _all_links(links: DataFrame, labels: DataFrame, made: DataFrame, class_texts: DataFrame, percent: int, size: int) -> DataFrame:
    """``class, n_links``: all links of every class. They lie within components.

    A component whose pairs are all linked already is done. The others are dealt into blocks of about ``LINK_BLOCK``
    classes, and every two blocks are compared as matrices: pairs are counted where they are found and never become rows.
    """
    of = labels.select(F.col("node").alias("class"), "component")
    sizes = of.groupBy("component").agg(F.count("*").alias("m"))
    known = of.join(made, "class").groupBy("component").agg(F.sum("n_links").alias("known"))
    unsure = sizes.join(known, "component").filter("known < m * (m - 1)").select("component", F.ceil(F.col("m") / LINK_BLOCK).alias("blocks"))
    rows = of.join(unsure, "component").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    # Few texts are needed. A class has several texts if rows share a doc_id; their sets are the same.
    needed = class_texts.join(rows.select("class"), "class", "left_semi")
    rows = rows.join(needed.dropDuplicates(["class"]), "class")
    pairs = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "block", "text"
    )

    def count(table: pa.Table) -> pa.Table:
        hasher, block = Hasher(), np.asarray(table.column("block"))
        keys, n = [], np.zeros(len(block), np.int64)
        at = 0
        for batch, data, borders in sliced(iter(table.combine_chunks().to_batches()), "text", SMALL_SLICE_BYTES):
            own, first = shingle_sets(data, borders, hasher, size)
            keys.append(own)
            n[at : at + batch.num_rows] = np.diff(first)
            at += batch.num_rows
        # Only shingles of several classes are shared; each is a column.
        _, column, found = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(n)), n)
        several = found[column] > 1
        row, column = row[several], (np.cumsum(found > 1) - 1)[column[several]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(n), len(n)), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, _LINK_COLUMNS):
            begin, end = np.searchsorted(column, (low, low + _LINK_COLUMNS))
            holds = np.zeros((len(n), _LINK_COLUMNS), np.float32)
            holds[row[begin:end], column[begin:end] - low] = 1
            shared += holds @ holds.T
        shared = shared.astype(np.int64)
        linked = (100 * shared >= percent * (n[:, None] + n[None, :] - shared)) & (shared > 0)
        if len(set(block.tolist())) > 1:
            linked &= block[:, None] != block[None, :]
        elif table.column("low")[0] != table.column("high")[0]:  # the other block is empty
            linked[:] = False
        np.fill_diagonal(linked, False)
        return pa.table({"class": table.column("class"), "n_links": pa.array(linked.sum(1).astype(np.int64))})

    counted = pairs.groupBy("component", "low", "high").applyInArrow(count, "class long, n_links long")
    counted = counted.groupBy("class").agg(F.sum("n_links").alias("all_links"))
    return made.join(counted, "class", "left").select("class", F.coalesce("all_links", "n_links").alias("n_links"))


def _not_in(pairs: DataFrame, seen: DataFrame | None) -> DataFrame:
    return pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti")


def _own_texts(sources: DataFrame, size: int) -> DataFrame:
    """Of texts found by doc_id, those that are their class's; rows that share a doc_id can hold others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "text", SMALL_SLICE_BYTES):
            keys, first = shingle_sets(data, borders, hasher, size)
            yield batch.filter(pa.array(set_hashes(keys, first, hasher).view(np.int64) == np.asarray(batch.column(0))))

    return sources.mapInArrow(run, "class long, text string")


def _labelled(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return shared.withColumn("component", F.col("class"))
    return (
        shared.join(labels, F.col("class") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "class"))
        .select(*shared.columns, "component")
    )


def _cross_pairs(known: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a shingle: components are paired first, then their classes.

    The shorter set of a similar pair has the first shared shingle so early that only then it can have enough shingles
    left, which halves its side.
    """
    least_left = F.ceil(F.col("n") * 2 * percent / F.lit(100.0 + percent) - 1e-9)
    shorter = known.filter(F.col("n") - F.col("at") >= least_left)
    groups = shorter.select("shingle", "component").distinct()
    # The most a component's sets can share from this shingle on, and their sizes, rule out most pairs of components.
    others = known.groupBy("shingle", F.col("component").alias("other_component")).agg(
        F.max(F.col("n") - F.col("at")).alias("most_left"), F.min("n").alias("low_n"), F.max("n").alias("high_n")
    )
    pairs = groups.join(others, "shingle").filter(F.col("component") != F.col("other_component"))
    open_pairs = (
        shorter.join(pairs, ["shingle", "component"])
        .filter((F.col("most_left") >= least_left) & (F.col("high_n") >= F.col("n")))
        .filter(F.col("low_n") * percent <= F.col("n") * 100)
    )
    right = known.select(
        "shingle",
        *(F.col(k).alias(f"other_{k}") for k in ("class", "n", "at", "component")),
    )
    met = open_pairs.join(right, ["shingle", "other_component"])
    fits, place = _could_link(F.col("n"), F.col("at"), F.col("other_n"), F.col("other_at"), percent)
    return (
        met.filter((F.col("n") <= F.col("other_n")) & fits & place)
        .select(F.least("class", "other_class").alias("a"), F.greatest("class", "other_class").alias("b"))
        .distinct()
    )


def _members_named(members: DataFrame, n_links: DataFrame, labels: DataFrame) -> DataFrame:
    """Components by their smallest doc_id."""
    n_links = n_links.withColumnRenamed("class", "_class")
    classes = members.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    grouped = classes.join(labels, F.col("class") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = (
        grouped.join(least, "component")
        .join(n_links, F.col("class") == F.col("_class"), "left")
        .select(F.col("class").alias("_c"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return members.join(named, F.col("class") == F.col("_c"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_of_each(documents: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``documents`` with one row of each component: that with its smallest doc_id. Texts without words all stay.

    Rows equal in doc_id and text stay once; rows that share a doc_id but not a text stay or go together.
    """
    classes = similarity_classes(documents, percent, size, count_links=False)
    kept = classes.filter((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Null doc_ids get a number and a mark, so that equal rows lie together for the join and for what follows it alike.
    doc_id = [F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("no_id")]
    rows = documents.select(*doc_id, F.xxhash64("text").alias("content"), F.struct("*").alias("row"))
    rows = rows.join(kept.select(*doc_id).distinct(), ["id", "no_id"], "left_semi").dropDuplicates(["id", "no_id", "content"])
    return rows.select(*(F.col("row").getField(c).alias(c) for c in documents.columns))
