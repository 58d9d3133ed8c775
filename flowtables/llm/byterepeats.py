"""Suffix-array dedup: bytes covered by a repeated string of 200 bytes go, found by threshold-bounded interval expansion.

Equal strings of 200 bytes must meet in one Burrows-Wheeler transform, and no transform may hold the whole corpus:

* A string's anchor is its least piece of 64 bytes by hash (leftmost among equals), which depends on its bytes alone.
  Neighbouring strings of a document with one anchor make a segment of 352 bytes or less. Segments are dealt by the hash of
  their anchor, so equal strings are in segments dealt alike. Anchors that occur once are left.
* Equal segments are one text with a count (copies, however many, are one). A group of one text needs no order. Texts of
  the other groups are fetched, and tasks put neighbouring groups together into transforms of about a million bytes.
* On each transform, intervals are expanded by backward extension, breadth-first: common prefixes come by increasing value
  and the search stops at 200 (``intervals``). What is left without a value recurs.
* A group with more text than one transform should hold is split by where the anchor lies in the string: by 16 places at
  first, then by single places. The bytes that all strings of a part have in common deal it again, and equal texts are
  folded again. Strings alike are never separated, and at single places a group is one string with a count.

Matches come back to documents as ranges of bytes, by joins on anchor and segment.

Texts are UTF-8 bytes; null is empty. Repeated rows are documents of their own, so their strings are repeated. Rows are
told apart by doc_id (null included) and a hash of the text. Kept bytes may cut a code point in two. An empty table gives
no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.intervals import repeated_starts
from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import Hasher, mapped, sliced, whole_windows

LENGTH = 200
ANCHOR = 64
#: About so many bytes make one transform; a group with more is split.
TRANSFORM_BYTES = 1 << 20
#: Places of the anchor per part when a group is split, coarse and then single.
SPLITS = (16, 1)
#: Long texts are worked through so many strings at a time.
BLOCK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)


def anchored_segments(data: np.ndarray, borders: np.ndarray, hasher: Hasher, length: int, anchor: int):
    """First string, number of strings, place of the anchor and its hash for each segment of some texts, in turn."""
    for text in np.flatnonzero(np.diff(borders) >= length) if len(data) > BLOCK else [None]:
        # Either all texts at once or a block of one text, sharing what its last strings need.
        low, high = (0, len(data)) if text is None else (int(borders[text]), int(borders[text + 1]))
        for begin in range(low, max(high - length + 1, low + 1), BLOCK):
            end = min(high, begin + BLOCK + length - 1)
            own = data[begin:end]
            starts = np.arange(max(0, len(own) - anchor + 1))
            hashes = hasher.of_bytes(own, starts, starts + anchor)
            keys = (hashes & ~_PLACE) | starts.astype(np.uint64)
            span, width = length - anchor + 1, 1
            if len(keys) < span:
                continue
            while 2 * width <= span:
                keys = np.minimum(keys[: len(keys) - width], keys[width:])
                width *= 2
            rest = span - width
            keys = np.minimum(keys[: len(keys) - rest], keys[rest:])
            strings = whole_windows(borders, length) if text is None else np.arange(len(keys))
            places = (keys[strings] & _PLACE).astype(np.int64)
            new = np.ones(len(places), bool)
            new[1:] = places[1:] != places[:-1]
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(places)))
            yield strings[first] + begin, n, places[first] + begin, hashes[places[first]]


def _own(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("content"), "text")


_SEGMENT = "doc_id long, content long, begin long, strings int, anchor long, segment long"


def segments(documents: DataFrame, length: int, anchor: int) -> DataFrame:
    """Every segment of every document: where it begins, how many strings it has, hashes of its anchor and its bytes."""

    def run(batch, data, borders, state):
        parts = list(anchored_segments(data, borders, state["hasher"], length, anchor))
        if not parts:
            return None
        begin, n, _, keys = (np.concatenate(c) for c in zip(*parts))
        if not len(begin):
            return None
        text = np.searchsorted(borders, begin, side="right") - 1
        hashes = state["hasher"].of_bytes(data, begin, begin + n + length - 1)
        return {
            "doc_id": batch.column(0).take(pa.array(text)),
            "content": batch.column(1).take(pa.array(text)),
            "begin": pa.array(begin - borders[text]),
            "strings": pa.array(n, pa.int32()),
            "anchor": pa.array(keys.view(np.int64)),
            "segment": pa.array(hashes.view(np.int64)),
        }

    return mapped(documents, run, "text", _SEGMENT)


def same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Rows of the same document, by doc_id (null included) and content."""
    r = right.withColumnsRenamed({"doc_id": "_doc_id", "content": "_content"})
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("content") == F.col("_content"))
    return left.join(r, match, how).drop("_doc_id", "_content")


_TEXT = "anchor long, segment long, shift int, n long, part long, same long, size int, bytes binary"


def fetched(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` (anchor, segment, n, doc_id, content, begin, strings), as parts of their own groups."""
    places = F.collect_list(F.struct("begin", "strings", "anchor", "segment", "n")).alias("places")
    joined = same_row(_own(documents), wanted.groupBy("doc_id", "content").agg(places), "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in sliced(batches, "text"):
            column = batch.column(batch.schema.get_field_index("places"))
            text = np.repeat(np.arange(batch.num_rows), np.asarray(column.value_lengths()))
            place = column.flatten()
            begin = np.asarray(place.field("begin")) + borders[text]
            end = begin + np.asarray(place.field("strings")) + length - 1
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": place.field("anchor"),
                    "segment": place.field("segment"),
                    "shift": pa.array(np.zeros(len(begin), np.int32)),
                    "n": place.field("n"),
                    "part": place.field("anchor"),
                    "same": place.field("segment"),
                    "size": pa.array((end - begin).astype(np.int32)),
                    "bytes": pa.array([data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                }
            )

    return joined.mapInArrow(run, _TEXT)


def split(texts: DataFrame, width: int, length: int, anchor: int) -> DataFrame:
    """Texts of too large groups as texts of groups by ``width`` places of the anchor and the bytes these share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch, data, borders in sliced(batches, "bytes"):
            # A text of one anchor: its first string has it leftmost, so it is where the first string has its least hash.
            first, place = borders[:-1], np.empty(batch.num_rows, np.int64)
            keys = batch.column(batch.schema.get_field_index("anchor")).to_numpy(zero_copy_only=False).view(np.uint64)
            starts = np.arange(max(0, len(data) - anchor + 1))
            hit = hasher.of_bytes(data, starts, starts + anchor)
            for i, (a, b) in enumerate(zip(first.tolist(), borders[1:].tolist())):
                place[i] = a + int(np.argmax(hit[a : b - anchor + 1] == keys[i]))
            # Strings by how many places they begin before the anchor, in classes of width.
            n = np.diff(borders) - length + 1
            most, least = place - first, place - first - n + 1
            classes = most // width - least // width + 1
            row = np.repeat(np.arange(batch.num_rows), classes)
            number = least[row] // width + np.arange(len(row)) - np.repeat(np.cumsum(classes) - classes, classes)
            low = np.maximum(place[row] - (number + 1) * width + 1, first[row])
            high = np.minimum(place[row] - number * width, first[row] + n[row] - 1)
            core_low, core_high = place[row] - number * width, place[row] - (number + 1) * width + 1 + length
            part = hasher.of_bytes(data, core_low, core_high) + number.astype(np.uint64)
            same = hasher.of_bytes(data, low, high + length)
            at, shift = pa.array(row), np.asarray(batch.column(batch.schema.get_field_index("shift")))
            taken = {c: batch.column(batch.schema.get_field_index(c)).take(at) for c in ("anchor", "segment", "n")}
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": taken["anchor"],
                    "segment": taken["segment"],
                    "shift": pa.array((shift[row] + low - first[row]).astype(np.int32)),
                    "n": taken["n"],
                    "part": pa.array(part.view(np.int64)),
                    "same": pa.array(same.view(np.int64)),
                    "size": pa.array((high - low + length).astype(np.int32)),
                    "bytes": pa.array([data[a:b].tobytes() for a, b in zip(low.tolist(), (high + length).tolist())], pa.binary()),
                }
            )

    return texts.select(*(c.split()[0] for c in _TEXT.split(", "))).mapInArrow(run, _TEXT)


_RANGES = "ranges array<struct<low: int, high: int>>"


def expanded(texts: DataFrame, length: int) -> DataFrame:
    """``part, same, ranges``: which strings of each text (part, same, n, bytes) recur within its part, as ranges of starts."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        borders = np.concatenate(([0], np.cumsum([len(h[3]) for h in held])))
        data = np.frombuffer(b"".join([h[3] for h in held]), np.uint8)
        # Strings of this length that are equal are in one group, so groups do not disturb each other.
        hits = repeated_starts(data, borders, np.array([h[2] for h in held]), length)
        change = np.diff(hits.astype(np.int8), prepend=0, append=0)
        low, high = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        text = np.searchsorted(borders, low, side="right") - 1
        sizes = np.bincount(text, minlength=len(held))
        spans = pa.StructArray.from_arrays(
            [pa.array((low - borders[text]).astype(np.int32)), pa.array((high - borders[text]).astype(np.int32))], ["low", "high"]
        )
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([h[0] for h in held], pa.int64()),
                "same": pa.array([h[1] for h in held], pa.int64()),
                "ranges": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), spans),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= TRANSFORM_BYTES and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield flush(held)

    ordered = texts.select("part", "same", "n", "bytes").repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(run, f"part long, same long, {_RANGES}")


def _whole(strings: F.Column) -> F.Column:
    return F.array(F.struct(F.lit(0).alias("low"), strings.cast("int").alias("high")))


def recurring(documents: DataFrame, length: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """Segments with anchors that recur, and ``anchor, segment, ranges``: which strings of those segments recur."""
    own = _own(documents)
    found = segments(own, length, anchor)
    anchors = stored(found.groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1").select("anchor"), "anchors")
    found = stored(found.join(anchors, "anchor").select(*(c.split()[0] for c in _SEGMENT.split(", "))), "segments")
    texts = found.groupBy("anchor", "segment").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "content", "begin", "strings")).alias("one")
    )
    texts = stored(texts, "distinct-segments")
    sizes = texts.groupBy("anchor").agg(F.count("*").alias("texts"))
    texts = texts.join(sizes, "anchor")
    alone = texts.filter("texts = 1 and n > 1").select("anchor", "segment", _whole(F.col("one.strings")).alias("ranges"))
    wanted = texts.filter("texts > 1").select("anchor", "segment", "n", "one.*")
    level = stored(fetched(documents, wanted, length), "segment-texts")
    groups = level.groupBy("part").agg(F.sum("size").alias("size"))
    large = stored(groups.filter(F.col("size") > TRANSFORM_BYTES).select("part"), "large-groups")
    small = expanded(level.join(large, "part", "left_anti"), length)
    ranges = alone.unionByName(small.withColumnsRenamed({"part": "anchor", "same": "segment"}))
    for width in SPLITS:
        if large.isEmpty():
            break
        level = stored(split(level.join(large, "part", "left_semi"), width, length, anchor), "split-texts")
        # Equal texts of a group are one.
        texts = level.groupBy("part", "same").agg(F.sum("n").alias("n"), F.first("size").alias("size"))
        groups = stored(texts.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("texts")), "groups")
        one = texts.join(groups.filter("texts = 1").select("part"), "part", "left_semi").filter("n > 1")
        judged = one.select("part", "same", _whole(F.col("size") - length + 1).alias("ranges"))
        if width > 1:
            several = groups.filter(f"texts > 1 and size <= {TRANSFORM_BYTES}").select("part")
            folded = level.join(several, "part", "left_semi").groupBy("part", "same")
            judged = judged.unionByName(expanded(folded.agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes")), length))
        back = level.select("part", "same", "anchor", "segment", "shift").join(judged, ["part", "same"])
        moved = F.transform(
            "ranges", lambda r: F.struct((r["low"] + F.col("shift")).alias("low"), (r["high"] + F.col("shift")).alias("high"))
        )
        ranges = ranges.unionByName(back.select("anchor", "segment", moved.alias("ranges")))
        large = stored(groups.filter(f"texts > 1 and size > {TRANSFORM_BYTES}").select("part"), "large-groups")
    return found, ranges


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def byte_dedup(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` per document; ``kept`` are the remaining bytes."""
    found, ranges = recurring(documents, length, anchor)
    ranges = stored(ranges, "ranges")
    spans = found.join(ranges, ["anchor", "segment"]).select("doc_id", "content", "begin", F.inline("ranges"))
    spans = spans.select("doc_id", "content", (F.col("begin") + F.col("low")).alias("low"), (F.col("begin") + F.col("high")).alias("high"))
    spans = spans.groupBy("doc_id", "content").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = same_row(_own(documents), spans, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, borders in sliced(batches, "text"):
            column = batch.column(batch.schema.get_field_index("spans"))
            text = np.repeat(np.arange(batch.num_rows), np.asarray(column.value_lengths().fill_null(0)))
            span = column.flatten()
            change = np.zeros(len(data) + 1, np.int32)
            # Strings that start from low to high (exclusive) cover the bytes up to the end of the last.
            np.add.at(change, np.asarray(span.field("low")) + borders[text], 1)
            np.add.at(change, np.asarray(span.field("high")) + borders[text] + length - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = borders[:-1][borders[:-1] < len(data)]
            opens[inner] = gone[inner]
            before = np.concatenate(([0], np.cumsum(opens)))
            sizes = np.diff(borders)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": pa.array(sizes),
                    "n_removed": pa.array(sizes - [len(k) for k in kept]),
                    "n_spans": pa.array(before[borders[1:]] - before[borders[:-1]]),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    return joined.mapInArrow(run, RESULT)
