"""Substring dedup on a sparse de Bruijn graph: words covered by a repeated window of 35 words go.

Nodes are token k-mers, edges the words from one node of a document to its next. Only k-mers that are the least of a
window (minimizers) are nodes: every window has one, and equal windows have the same. An edge's two ends are told apart
by hashes of all words between, borders of documents included.

* Nodes found more than once, and whether all their occurrences have the same edges before and after (nonbranching), come
  from one aggregation; joins bring that back to the occurrences, which compacts the nonbranching paths: wherever such a
  node occurs, the path goes on alike on both sides.
* A window whose nodes are all nonbranching and repeated lies in a compacted path, so it is repeated. A window whose least
  k-mer occurs once is not. The others, at the ends of paths, are verified by source coordinates: their whole word
  sequences are hashed and counted. A window in a path equals only windows in paths, so counting those left is exact.

Work on windows is thus needed near branches only; exact copies, however many, are paths without branches.

Words are runs of bytes other than white space, unchanged. Null and empty texts have no words. Repeated rows are
documents of their own, so their windows are repeated. Rows are told apart by doc_id (null included) and a hash of the
text, not by doc_id alone. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import WORD, Hasher, covered, mapped, mixed, owners, runs, sliced, whole_windows, windows

WINDOW = 35
K = 8
_PLACE = np.uint64((1 << 24) - 1)


class Graph:
    """The nodes of one slice of texts."""

    def __init__(self, data: np.ndarray, borders: np.ndarray, hasher: Hasher, window: int, k: int) -> None:
        self.starts, self.ends, self.first = runs(data, borders, WORD)
        self.hashes = hasher.of_bytes(data, self.starts, self.ends)
        n, span = len(self.hashes), window - k + 1
        self.begins = whole_windows(self.first, window)
        kmers = windows(self.hashes, k)
        # The least k-mer of each window, leftmost among equals: hashes give way to places in their last bits.
        keys = (kmers & ~_PLACE) | (np.arange(len(kmers), dtype=np.uint64) & _PLACE)
        least, width = keys, 1
        while 2 * width <= span:
            least = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        rest = span - width
        least = np.minimum(least[: len(least) - rest], least[rest:])[self.begins] if len(self.begins) else keys[:0]
        base = self.begins.astype(np.uint64)
        self.minimizer = (base + ((least - base) & _PLACE)).astype(np.int64)
        new = np.ones(len(self.minimizer), bool)
        new[1:] = self.minimizer[1:] != self.minimizer[:-1]
        #: Places of the nodes, and the node that is each window's least k-mer.
        self.nodes = self.minimizer[new]
        self.node_of_window = np.cumsum(new) - 1
        self.node_keys = kmers[self.nodes]
        self.doc = np.searchsorted(self.first, self.nodes, side="right") - 1
        m = len(self.nodes)
        border_before, border_after = np.ones(m, bool), np.ones(m, bool)
        border_before[1:] = border_after[:-1] = self.doc[1:] != self.doc[:-1]
        before = np.where(border_before, self.first[self.doc], np.concatenate(([0], self.nodes[:-1]))[:m])
        after = np.where(border_after, self.first[self.doc + 1], np.concatenate((self.nodes[1:], [0]))[:m] + k)
        words = mixed(self.hashes)
        left = hasher.ranges(words, before, self.nodes + k) + border_before.astype(np.uint64)
        right = hasher.ranges(words, self.nodes, after) + border_after.astype(np.uint64)
        self.edges = mixed(left * np.uint64(0xD6E8FEB86659FD93) + right)
        self.number = np.arange(m) - np.searchsorted(self.doc, self.doc)


def _with_content(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("content"), "text")


def node_occurrences(documents: DataFrame, window: int, k: int) -> DataFrame:
    """``doc_id, content, number, node, edges``: each node of each document and its two edges."""

    def run(batch, data, borders, state):
        g = Graph(data, borders, state["hasher"], window, k)
        if not len(g.nodes):
            return None
        at = pa.array(g.doc)
        return {
            "doc_id": batch.column(0).take(at),
            "content": batch.column(1).take(at),
            "number": pa.array(g.number, pa.int32()),
            "node": pa.array(g.node_keys.view(np.int64)),
            "edges": pa.array(g.edges.view(np.int64)),
        }

    return mapped(documents, run, "text", "doc_id long, content long, number int, node long, edges long")


def _digests(starts, ends, data, keep, first) -> list[str]:
    """The digest of each text's kept words, joined by single spaces."""
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = np.flatnonzero(keep[a:b]) + a
        # Neighbouring kept words are cut out together; white space between them becomes single spaces.
        if len(own) == b - a and b > a:
            text = b" ".join(data[starts[a] : ends[b - 1]].tobytes().split())
        elif len(own):
            new = np.flatnonzero(np.diff(own) != 1)
            low, high = own[np.concatenate(([0], new + 1))], own[np.concatenate((new, [len(own) - 1]))]
            text = b" ".join([b" ".join(data[starts[i] : ends[j]].tobytes().split()) for i, j in zip(low, high)])
        else:
            text = b""
        out.append(hashlib.sha256(text).hexdigest())
    return out


RESULT = "doc_id long, content long, n_words long, n_removed long, kept_sha256 string"


def untouched(documents: DataFrame) -> DataFrame:
    """The result of each document as if nothing were repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in sliced(batches, "text"):
            n_words, digests = [], []
            for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                words = data[a:b].tobytes().split()
                n_words.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "content": batch.column(1),
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array([0] * batch.num_rows, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
            )

    return documents.mapInArrow(run, RESULT)


def _states(batch: pa.RecordBatch, g: Graph) -> np.ndarray:
    """Of each node 0 (occurs once), 1 (repeated, nonbranching) or 2 (branching), from the batch's ``nodes`` column."""
    states = np.zeros(len(g.nodes), np.int8)
    column = batch.column(batch.schema.get_field_index("nodes"))
    begin = np.searchsorted(g.doc, np.arange(batch.num_rows))
    sizes = np.asarray(column.value_lengths())
    coded = np.asarray(column.flatten())
    states[np.repeat(begin, sizes) + coded // 2] = 1 + coded % 2
    return states


def _judged(g: Graph, states: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows lie in compacted paths, and which must be verified."""
    low = np.searchsorted(g.nodes, g.begins)
    high = np.searchsorted(g.nodes, g.begins + window - k, side="right")
    steady = np.concatenate(([0], np.cumsum(states == 1)))
    in_path = steady[high] - steady[low] == high - low
    repeated = states[g.node_of_window] > 0
    return repeated & in_path, repeated & ~in_path


def open_windows(found: DataFrame, window: int, k: int) -> DataFrame:
    """``doc_id, content, place, sequence``: windows to verify, by the hash of all their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "text"):
            g = Graph(data, borders, hasher, window, k)
            _, left = _judged(g, _states(batch, g), window, k)
            begins = g.begins[left]
            if len(begins):
                doc = np.searchsorted(g.first, begins, side="right") - 1
                sequences = hasher.ranges(mixed(g.hashes), begins, begins + window)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).take(pa.array(doc)),
                        "content": batch.column(1).take(pa.array(doc)),
                        "place": pa.array(begins - g.first[doc], pa.int32()),
                        "sequence": pa.array(sequences.view(np.int64)),
                    }
                )

    return found.mapInArrow(run, "doc_id long, content long, place int, sequence long")


def removed(found: DataFrame, window: int, k: int) -> DataFrame:
    """The results of documents with repeated nodes; ``places`` are their verified windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "text"):
            g = Graph(data, borders, hasher, window, k)
            in_path, _ = _judged(g, _states(batch, g), window, k)
            places = batch.column(batch.schema.get_field_index("places"))
            sizes = np.asarray(places.value_lengths().fill_null(0))
            checked = np.repeat(g.first[:-1], sizes) + np.asarray(places.flatten(), dtype=np.int64)
            gone = covered(np.concatenate((g.begins[in_path], checked)), window, len(g.starts))
            total = np.concatenate(([0], np.cumsum(gone)))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "content": batch.column(1),
                    "n_words": pa.array(np.diff(g.first), pa.int64()),
                    "n_removed": pa.array(total[g.first[1:]] - total[g.first[:-1]], pa.int64()),
                    "kept_sha256": pa.array(_digests(g.starts, g.ends, data, ~gone, g.first), pa.string()),
                }
            )

    return found.mapInArrow(run, RESULT)


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    r = right.withColumnsRenamed({"doc_id": "_doc_id", "content": "_content"})
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("content") == F.col("_content"))
    return left.join(r, match, how).drop("_doc_id", "_content")


def substring_dedup(documents: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document."""
    own = _with_content(documents)
    occurrences = node_occurrences(own, window, k)
    nodes = (
        occurrences.groupBy("node")
        .agg(F.count("*").alias("n"), F.min("edges").alias("low"), F.max("edges").alias("high"))
        .filter("n > 1")
        .select("node", (F.col("low") != F.col("high")).cast("int").alias("branching"))
    )
    # Written, so that Spark can split a node's many occurrences when it joins them.
    nodes = stored(nodes, "repeated-nodes")
    states = (
        occurrences.select("doc_id", "content", "number", "node")
        .join(nodes, "node")
        .select("doc_id", "content", (F.col("number") * 2 + F.col("branching")).alias("coded"))
        .groupBy("doc_id", "content")
        .agg(F.collect_set("coded").alias("nodes"))
    )
    states = stored(states, "node-states")
    found = stored(_same_row(own, states, "inner"), "documents-with-repeats")
    left = stored(open_windows(found, window, k), "open-windows")
    repeated = left.groupBy("sequence").agg(F.count("*").alias("n")).filter("n > 1").select("sequence")
    repeated = stored(repeated, "repeated-sequences")
    checked = (
        left.join(repeated, "sequence")
        .groupBy("doc_id", "content")
        .agg(F.collect_set("place").alias("places"))
    )
    touched = removed(_same_row(found, checked, "left"), window, k)
    rest = _same_row(untouched(own), states.select("doc_id", "content"), "left_anti")
    return touched.unionByName(rest).drop("content")
