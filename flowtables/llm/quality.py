"""Quality rules: base counts per document, and a content/boilerplate labelling of its lines by a linear-chain CRF.

Each line with a word is an item of its document's chain; the best labels come from Viterbi decoding in NumPy batches.
A document is kept if it passes the base rule and at least ``CONTENT_SHARE`` of its characters are in content lines.

The field is trained on labelled documents: lines of good documents (quality 1) count as content, lines of bad ones as
boilerplate. The sample has at most ``SAMPLE_DOCS`` documents, those with the smallest hashes of their doc_id, over their
whole length: chains of ``CHAIN_LINES`` lines, of which at most ``SAMPLE_CHAINS`` are taken, those with the smallest hashes
again. Everything else covers all lines of all documents. Without labels of both kinds only the base rule decides.

Null and empty texts have no words: all counts are 0 and the base rule fails. Repeated rows are judged alike, extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm import crf
from flowtables.llm.textkernel import (
    CODE_POINT, WORD, byte_table, covered, mapped, owners, runs, sums, whole_windows, windows,
)

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
CONTENT_SHARE = 0.5
SAMPLE_DOCS = 2000
#: Longer documents are several chains in training, and so many chains of the sample are used at most.
CHAIN_LINES = 48
SAMPLE_CHAINS = 20_000
SYMBOLS = byte_table(b"#*$%&|<>")
_UPPER = byte_table(range(65, 91))
_LETTER = byte_table([*range(65, 91), *range(97, 123), *range(0x80, 0x100)])
_DIGIT = byte_table(range(48, 58))
_MARK = byte_table(b"!?.,;:|")
_FINAL = byte_table(b".!?\"'")
N_FEATURES = 15


class Lines:
    """Words, lines and counts of one slice of texts."""

    def __init__(self, data: np.ndarray, borders: np.ndarray, state: dict) -> None:
        hasher = state["hasher"]
        self.n_docs = len(borders) - 1
        starts, ends, first = runs(data, borders, WORD)
        self.first = first
        points = np.concatenate(([0], np.cumsum(CODE_POINT[data])))
        self.word_points = points[ends] - points[starts]
        self.word_chars = sums(self.word_points, first)
        self.n_words = np.diff(first)
        self.n_symbols = sums(SYMBOLS[data], borders)
        # Words in 8-word windows that the same text holds twice.
        begins = whole_windows(first, WINDOW)
        doc = owners(first)
        hashes = hasher.of_bytes(data, starts, ends)
        keys = windows(hashes, WINDOW)[begins]
        self.repeated = covered(begins[_twice(doc[begins], keys)], WINDOW, len(starts))
        self.n_repeated = sums(self.repeated, first)
        # Lines with a word.
        breaks = np.flatnonzero(data == 10)
        line_doc = np.searchsorted(borders, breaks, side="right") - 1
        line_from = np.concatenate((borders[:-1], breaks + 1))
        line_to = np.concatenate((breaks, borders[1:]))
        # The k-th line of a text ends at its k-th break; a text's last line at its border.
        order_from = np.lexsort((line_from, np.concatenate((np.arange(self.n_docs), line_doc))))
        order_to = np.lexsort((line_to, np.concatenate((line_doc, np.arange(self.n_docs)))))
        line_doc = np.sort(np.concatenate((line_doc, np.arange(self.n_docs))))
        line_from, line_to = line_from[order_from], line_to[order_to]
        word_from, word_to = np.searchsorted(starts, line_from), np.searchsorted(starts, line_to)
        filled = word_to > word_from
        self.line_doc, line_from, line_to = line_doc[filled], line_from[filled], line_to[filled]
        self.word_from, self.word_to = word_from[filled], word_to[filled]
        line_keys = hasher.of_bytes(data, line_from, line_to)
        again = ~_first(self.line_doc, line_keys)
        self.n_dup_lines = np.bincount(self.line_doc[again], minlength=self.n_docs)
        self.line_points = (points[line_to] - points[line_from]).astype(float)
        self.line_first = np.searchsorted(self.line_doc, np.arange(self.n_docs + 1))
        self.features = self._features(data, starts, ends, line_from, line_to, again)

    def _features(self, data, starts, ends, line_from, line_to, again) -> np.ndarray:
        def share(table: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(table[data])))
            return (total[line_to] - total[line_from]) / np.maximum(line_to - line_from, 1)

        n_words = self.word_to - self.word_from
        repeated = np.concatenate(([0], np.cumsum(self.repeated)))
        repeated = (repeated[self.word_to] - repeated[self.word_from]) / np.maximum(n_words, 1)
        points = np.concatenate(([0], np.cumsum(self.word_points)))
        mean = (points[self.word_to] - points[self.word_from]) / np.maximum(n_words, 1)
        final = _FINAL[data[ends[self.word_to - 1] - 1]] if len(n_words) else np.zeros(0, bool)
        letters, upper, symbols = share(_LETTER), share(_UPPER), share(SYMBOLS)
        marks, digits = share(_MARK), share(_DIGIT)
        return np.column_stack(
            (
                np.ones(len(n_words), bool), n_words < 4, (n_words >= 4) & (n_words < 12), n_words >= 12, symbols > 0.02,
                symbols > 0.08, upper > 0.4, marks > 0.08, marks > 0.2, letters < 0.6, digits > 0.2, repeated > 0.3,
                again, final, (mean < 2.5) | (mean > 14),
            )
        ).astype(np.float32)


def _twice(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which (doc, key) pairs occur more than once."""
    order = np.lexsort((keys, doc))
    d, k = doc[order], keys[order]
    same = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    out = np.zeros(len(doc), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _first(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which (doc, key) pairs have no equal one before them."""
    order = np.lexsort((keys, doc))
    d, k = doc[order], keys[order]
    out = np.ones(len(doc), bool)
    out[order[1:][(d[1:] == d[:-1]) & (k[1:] == k[:-1])]] = False
    return out


def train(documents: DataFrame, labels: DataFrame, docs: int = SAMPLE_DOCS, lines: int = CHAIN_LINES) -> dict | None:
    """The field's weights, or None without labels of both kinds."""
    rule = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # Half of the sample of each kind. The sample is bounded by its parameter, and so is its broadcast.
    halves = [
        rule.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs // 2) for q in (0, 1)
    ]
    sample = F.broadcast(halves[0].unionByName(halves[1]))
    text = documents.select("doc_id", "text").filter(F.col("text").isNotNull())

    def features(batch, data, borders, state):
        found = Lines(data, borders, state)
        chains = -(-np.diff(found.line_first) // lines)
        text = np.repeat(np.arange(batch.num_rows), chains)
        number = np.arange(len(text)) - np.repeat(np.cumsum(chains) - chains, chains)
        low = found.line_first[text] + number * lines
        high = np.minimum(low + lines, found.line_first[text + 1])
        return {
            "doc_id": batch.column(0).take(pa.array(text)),
            "quality": batch.column(1).take(pa.array(text)),
            "chain": pa.array(number, pa.int64()),
            "n_lines": pa.array(high - low, pa.int64()),
            "features": pa.array([found.features[a:b].astype(np.uint8).tobytes() for a, b in zip(low, high)], pa.binary()),
        }

    schema = "doc_id long, quality int, chain long, n_lines long, features binary"
    joined = text.join(sample, "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    chains = mapped(joined, features, "text", schema).orderBy(F.xxhash64("doc_id", "chain"), "doc_id", "chain", "features")
    rows = sorted(chains.limit(SAMPLE_CHAINS).collect(), key=lambda r: (r["doc_id"], r["chain"], bytes(r["features"])))
    if len({r["quality"] for r in rows}) < 2:
        return None
    x = np.concatenate([np.frombuffer(r["features"], np.uint8).reshape(-1, N_FEATURES) for r in rows]).astype(float)
    sizes = np.array([r["n_lines"] for r in rows])
    first = np.concatenate(([0], np.cumsum(sizes)))
    return crf.fit(x, np.repeat([r["quality"] for r in rows], sizes), first, 2, steps=120)


COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, content_share double"


def quality_rules(documents: DataFrame, weights: dict | None) -> DataFrame:
    """One row per document: base counts, base verdict, content share and ``kept``."""

    def judge(batch, data, borders, state):
        found = Lines(data, borders, state)
        share = np.ones(found.n_docs)
        if weights is not None and len(found.features):
            chains = np.concatenate((found.line_first[:-1][np.diff(found.line_first) > 0], [len(found.line_doc)]))
            content = crf.viterbi(found.features @ weights["emit"], chains, weights["start"], weights["step"], weights["end"])
            total = np.bincount(found.line_doc, found.line_points, found.n_docs)
            good = np.bincount(found.line_doc, found.line_points * (content == 1), found.n_docs)
            share = np.where(total > 0, good / np.maximum(total, 1), 1.0)
        failed = (found.n_words < MIN_WORDS) | (100 * found.n_repeated > MAX_REPEATED_PERCENT * found.n_words)
        return {
            "doc_id": batch.column(0),
            "n_words": pa.array(found.n_words, pa.int64()),
            "word_chars": pa.array(found.word_chars, pa.int64()),
            "n_symbols": pa.array(found.n_symbols, pa.int64()),
            "n_dup_lines": pa.array(found.n_dup_lines, pa.int64()),
            "n_repeat_words": pa.array(found.n_repeated, pa.int64()),
            "base_failed": pa.array(failed),
            "kept": pa.array(~failed & (share >= CONTENT_SHARE)),
            "n_lines": pa.array(np.diff(found.line_first), pa.int64()),
            "content_share": pa.array(share),
        }

    return mapped(documents.select(F.col("doc_id").cast("long"), "text"), judge, "text", COLUMNS)
