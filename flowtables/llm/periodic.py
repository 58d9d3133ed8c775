"""Periodic runs of words: stretches that repeat with a short period, found tile by tile and stitched by document and period.

A run is a maximal stretch of words with smallest period q and a length of at least max(6, 4 q). With matches at the places
i where word i equals word i + q, it is a maximal stretch of at least 3 q matches.

* Periods are solved by octave, P to 2 P - 1. Each octave lays tiles over a document whose boundaries are 3 P words apart,
  and a stretch of matches of a run holds at least one boundary. A tile reaches 3 P matches to both sides of its boundary,
  so neighbours overlap.
* Of a tile, the forward and the backward Z-function at its boundary are needed: how far the words there agree with those
  shifted by p, for each p of the octave. They are bisected on hashes of ranges for all tiles and shifts of a slice at
  once, and then compared word by word for what is passed on.
* What ends inside a tile is judged there; what reaches a tile's edge is a fragment. Fragments whose words have a smaller
  period, a divisor, belong to that period's runs and are left out: a fragment has 2.5 periods at least, hence its whole
  stretch has the divisor as a period too. Fragments are shuffled by document and period and stitched where they overlap.

Work per octave is a third of a pair per word. Texts do not leave their task, but for documents that have fragments.

Words are runs of bytes other than white space, unchanged. Before the search, ``looped`` may make the end of a document
periodic (the contract of the query). A null or empty text has no words and no run. Repeated rows give equal results each;
rows are told apart by doc_id (null included) and a hash of the text. A null doc_id is never looped. An empty table gives
no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import WORD, Hasher, runs, sliced

MIN_LENGTH = 6
MIN_EXPONENT = 4


def loop_of(doc_id: int, n: int) -> tuple[int, int] | None:
    """From which word on, and with which period, a document of ``n`` words is made periodic, if it is."""
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    begin = g % n
    return begin, 1 + (n - begin) // (3 + g % 8)


class Ranges:
    """Whether ranges of a sequence of 64-bit numbers are equal, by hashes."""

    def __init__(self, values: np.ndarray, hasher: Hasher) -> None:
        self.values = values
        hasher._reach(len(values))
        self.down = hasher.down
        self.total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * hasher.up[: len(values)], out=self.total[1:])

    def alike(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` values from ``a`` on are those from ``b`` on."""
        left = (self.total[a + n] - self.total[a]) * self.down[a]
        return left == (self.total[b + n] - self.total[b]) * self.down[b]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many values from ``a`` on (or before it) are those at ``b``, up to ``most``: values of a Z-function."""
        low, high = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            half = (low + high + 1) // 2
            same = self.alike(a - half, b - half, half) if back else self.alike(a, b, half)
            low = np.where(same, half, low)
            high = np.where(same, high, half - 1)
        return low


def _ranged(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _prime_factors(limit: int) -> np.ndarray:
    """The least prime factor of each number up to ``limit``."""
    least = np.arange(limit + 1)
    for f in range(2, int(limit**0.5) + 1):
        if least[f] == f:
            own = least[f * f :: f]
            own[own == np.arange(f * f, limit + 1, f)] = f
    return least


def _primitive(r: Ranges, low: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no proper divisor of the period is a period of the words from ``low`` to ``end``."""
    out = np.ones(len(low), bool)
    if not len(low):
        return out
    least, rest = _prime_factors(int(period.max())), period.copy()
    while (open_ := np.flatnonzero(rest > 1)).size:
        prime = least[rest[open_]]
        d = period[open_] // prime
        out[open_] &= ~r.alike(low[open_], low[open_] + d, end[open_] - low[open_] - d)
        rest[open_] //= prime
    return out


def _settled(values: np.ndarray, low, high, boundary, period) -> tuple[np.ndarray, np.ndarray]:
    """Borders of fragments, compared value by value: hashes can only have made them too wide."""
    for i, (a, b, at, p) in enumerate(zip(low.tolist(), high.tolist(), boundary.tolist(), period.tolist())):
        differs = values[a:b] != values[a + p : b + p]
        if differs.any():
            places = np.flatnonzero(differs) + a
            low[i] = max(places[places < at].max(initial=a - 1) + 1, a)
            high[i] = places[places >= at].min(initial=b)
    return low, high


def tile_fragments(values: np.ndarray, first: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """Fragments of all texts of a slice: text, period, and first and last place (exclusive, in the slice) of matches."""
    r = Ranges(values, hasher)
    sizes, found, octave = np.diff(first), [], 1
    while MIN_EXPONENT * octave <= sizes.max(initial=0):
        text = np.flatnonzero(sizes >= MIN_EXPONENT * octave)
        reach = (MIN_EXPONENT - 1) * octave
        tiles = -(-(sizes[text] - octave) // reach)
        owner = np.repeat(text, tiles)
        boundary = first[owner] + _ranged(tiles) * reach
        # Every tile with every shift of the octave; the words at the boundary must agree.
        shifts = np.minimum(octave, first[owner + 1] - boundary - octave)
        at, owner = np.repeat(boundary, shifts), np.repeat(owner, shifts)
        period = octave + _ranged(shifts)
        hit = np.flatnonzero(values[at] == values[at + period])
        at, owner, period = at[hit], owner[hit], period[hit]
        forward = r.reach(at, at + period, np.minimum(reach, first[owner + 1] - at - period), back=False)
        backward = r.reach(at, at + period, np.minimum(reach, at - first[owner]), back=True)
        low, high = at - backward, at + forward
        cut = ((backward == reach) & (low > first[owner])) | ((forward == reach) & (high + period < first[owner + 1]))
        keep = cut | (high - low >= np.maximum(reach // octave * period, MIN_LENGTH - period))
        keep[keep] = _primitive(r, low[keep], (high + period)[keep], period[keep])
        low, high = _settled(values, low[keep], high[keep], at[keep], period[keep])
        found.append((owner[keep], period[keep], low, high))
        octave *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*found))


def _looped_order(batch: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    order = np.arange(first[-1])
    for i, doc_id in enumerate(batch.column(0).to_pylist()):
        a, b = int(first[i]), int(first[i + 1])
        loop = None if doc_id is None else loop_of(doc_id, b - a)
        if loop is not None:
            begin, period = loop
            tail = order[a + begin : b]
            tail[:] = a + begin + np.arange(len(tail)) % period
    return order


_FRAGMENTS = "fragments array<struct<period: long, low: long, high: long>>"


def fragments(documents: DataFrame, looped: bool) -> DataFrame:
    """``doc_id, content, n, sha256, words, fragments``: the words (joined by spaces) only where there are fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "text"):
            starts, ends, first = runs(data, borders, WORD)
            values = hasher.of_bytes(data, starts, ends)
            order = _looped_order(batch, first) if looped else np.arange(len(values))
            owner, period, low, high = tile_fragments(values[order], first, hasher)
            by_text = np.argsort(owner, kind="stable")
            owner, period, low, high = owner[by_text], period[by_text], low[by_text], high[by_text]
            digests, words = [], []
            has = np.bincount(owner, minlength=batch.num_rows) > 0
            plain = order == np.arange(len(order))
            for i in range(batch.num_rows):
                own = data[borders[i] : borders[i + 1]].tobytes().split()
                a, b = first[i], first[i + 1]
                if not plain[a:b].all():
                    own = [own[k] for k in (order[a:b] - a).tolist()]
                joined = b" ".join(own)
                digests.append(None if has[i] else hashlib.sha256(joined).hexdigest())
                words.append(joined.decode() if has[i] else None)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))))
            parts = pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in (period, low - first[owner], high - first[owner])], ["period", "low", "high"]
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "content": batch.column(1),
                    "n": pa.array(np.diff(first), pa.int64()),
                    "sha256": pa.array(digests, pa.string()),
                    "words": pa.array(words, pa.string()),
                    "fragments": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts),
                }
            )

    own = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("content"), "text")
    return own.mapInArrow(run, f"doc_id long, content long, n long, sha256 string, words string, {_FRAGMENTS}")


def stitched(found: DataFrame) -> DataFrame:
    """``doc_id, content, start, length, period``: fragments of a document and period, united where they overlap."""
    pieces = found.select("doc_id", "content", F.inline("fragments")).distinct()
    same = Window.partitionBy("doc_id", "content", "period")
    ordered = same.orderBy("low", "high")
    before = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("opens", (before.isNull() | (F.col("low") > before)).cast("int"))
    marked = marked.withColumn("stretch", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    length = F.max("high") - F.min("low") + F.col("period")
    out = marked.groupBy("doc_id", "content", "period", "stretch").agg(F.min("low").alias("start"), length.alias("length"))
    shortest = F.greatest(F.lit(MIN_LENGTH), MIN_EXPONENT * F.col("period"))
    return out.filter(F.col("length") >= shortest).select("doc_id", "content", "start", "length", "period")


_RUNS = "array<struct<start: long, length: long, period: long>>"


def _collapsed(found: DataFrame) -> DataFrame:
    """``collapsed_sha256``: the digest of the words that no run covers after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            digests = batch.column(names.index("sha256")).to_pylist()
            lists = batch.column(names.index("runs"))
            words = batch.column(names.index("words"))
            for i, digest in enumerate(digests):
                if digest is None:
                    own = words[i].as_py().encode().split(b" ")
                    change = np.zeros(len(own) + 1, np.int64)
                    for one in lists[i].as_py() or ():
                        change[one["start"] + one["period"]] += 1
                        change[one["start"] + one["length"]] -= 1
                    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                    digests[i] = hashlib.sha256(b" ".join([own[k] for k in kept])).hexdigest()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(names.index("doc_id")),
                    "runs": lists,
                    "collapsed_sha256": pa.array(digests, pa.string()),
                }
            )

    return found.mapInArrow(run, f"doc_id long, runs {_RUNS}, collapsed_sha256 string")


def periodic_runs(documents: DataFrame, looped: bool = False) -> DataFrame:
    """``doc_id, runs, collapsed_sha256`` per document: all runs by start and period, and the text without repeats."""
    found = stored(fragments(documents, looped), "fragments")
    own = stitched(found).groupBy("doc_id", "content").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    own = own.select(
        F.col("doc_id").alias("_doc_id"),
        F.col("content").alias("_content"),
        F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"),
    )
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("content") == F.col("_content"))
    joined = found.join(own, match, "left").select("doc_id", "sha256", "words", "runs")
    return _collapsed(joined).select("doc_id", F.coalesce("runs", F.array().cast(_RUNS)).alias("runs"), "collapsed_sha256")


def periodic_run_digests(documents: DataFrame) -> DataFrame:
    """The contract of the query: documents looped, and the runs of each as numbers and digests."""
    out = periodic_runs(documents, looped=True)
    # The longest run; among equals the smallest start, then the smallest period.
    first = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.withColumn("first", first).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("first.start").alias("start"),
        (-F.col("first.less")).alias("length"),
        F.col("first.period").alias("period"),
        F.expr("(1000 * -first.less) div first.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )
