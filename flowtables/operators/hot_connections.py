"""Reading one long framed connection with many tasks.

Where a frame begins depends on all lengths before it, so a connection seems to need one reader. But inside a block
of its bytes, every place that could be a frame start can be followed to where its chain of frames leaves the block.
That is done for all blocks at once. Chaining the blocks of a connection is then one lookup per block, on a few numbers
instead of bytes, and tells each block where its first frame begins; after that all blocks are cut side by side.

A place is followed only if its lengths are plausible (header below 16 MiB, payload below 256 TiB), and each block
passes on its first places only. A connection whose true chain runs into a place not passed on is reported as
unresolved and must be read in turn.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.operators.framecutter import LENGTHS, LENGTHS_BYTES, FrameCutter, few_bytes, piece_batch

# Plausible headers are shorter than this.
MAX_HEADER_BYTES = 1 << 24

_PASSED_ON = 64
_CHAINS = "starts array<long>, exits array<long>, counts array<long>, lasts array<long>"


def frame_chains(data: bytes, start: int, prefix: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """For the first places in a block that can begin a frame: where their chain of frames leaves the block, how many
    frames it has, and where its last one begins. All as offsets on the connection."""
    inside = len(data) - prefix + 1  # places whose fixed prefix is all here
    if inside <= 0:
        return [], [], [], []
    zero = np.frombuffer(data, dtype=np.uint8) == 0
    at = prefix - LENGTHS_BYTES
    plausible = zero[at : at + inside] & zero[at + 4 : at + 4 + inside] & zero[at + 5 : at + 5 + inside]
    ends: dict[int, tuple[int, int, int] | None] = {}  # None: the chain runs into an implausible place
    kept: list[int] = []
    for place in map(int, np.flatnonzero(plausible)):
        trail, here = [], place
        while here < inside and here not in ends and plausible[here]:
            trail.append(here)
            header_len, payload_len = struct.unpack_from(LENGTHS, data, here + at)
            here += prefix + header_len + payload_len
        end = (here, 0, here) if here >= inside else ends.get(here)
        for passed in reversed(trail):
            end = end and (end[0], end[1] + 1, end[2] if end[1] else passed)
            ends[passed] = end
        if ends[place]:
            kept.append(place)
            if len(kept) == _PASSED_ON:
                break
    return (
        [start + p for p in kept],
        [start + ends[p][0] for p in kept],
        [ends[p][1] for p in kept],
        [start + ends[p][2] for p in kept],
    )


class _Chain:
    """Follows one connection from block to block."""

    def __init__(self):
        self.at, self.frames, self.open_start, self.lost = 0, 0, None, False

    def enter(self, block_end: int, full_to: int, chains: tuple) -> tuple:
        """``(entry, frames before it, start and end of the frame still open, lost)`` of the next block."""
        entry = self.at if self.at < block_end else None
        row = (entry, self.frames, self.open_start, self.at, False)
        if entry is None or entry >= full_to:  # inside a payload, or a prefix that the connection never finished
            return row
        starts, exits, counts, lasts = chains
        if entry not in starts:
            self.lost = True
            return (None, None, None, None, True)
        i = starts.index(entry)
        self.at, self.frames, self.open_start = exits[i], self.frames + counts[i], lasts[i]
        return row


def cut_blocks(
    blocks: DataFrame, conn: str, prefix: int, block_bytes: int, max_blob_bytes: int | None
) -> tuple[DataFrame, DataFrame]:
    """The frame pieces of the connections in ``blocks`` (``conn, block, start, bytes``, each with the ``prefix - 1``
    bytes that follow it), and the connections that could not be resolved."""
    conn_type = blocks.schema[conn].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches):
            names, numbers, starts, data = (batch.column(i) for i in range(4))
            chains = [frame_chains(d.as_py(), s.as_py(), prefix) for s, d in zip(starts, data)]
            columns = [pa.array([c[i] for c in chains], pa.list_(pa.int64())) for i in range(4)]
            full_to = [s.as_py() + len(d.as_py()) - prefix + 1 for s, d in zip(starts, data)]
            yield pa.RecordBatch.from_arrays(
                [names, numbers, pa.array(full_to, pa.int64()), *columns],
                names=[conn, "block", "full_to", "starts", "exits", "counts", "lasts"],
            )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain = None, None
        for batch in batches:
            names, numbers, rows = [], [], []
            for name, block, full_to, *chains in zip(*(c.to_pylist() for c in batch.columns)):
                if chain is None or name != current:
                    current, chain = name, _Chain()
                if not chain.lost:
                    names.append(name)
                    numbers.append(block)
                    rows.append(chain.enter((block + 1) * block_bytes, full_to, chains))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64()] * 4 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, batch.schema.field(0).type), pa.array(numbers, pa.int64())]
                + [pa.array(c, t) for c, t in zip(columns, types)],
                names=[conn, "block", "entry", "frames", "open_start", "open_end", "lost"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches):
            for name, block, data, entry, frames, open_start, open_end in zip(*(c.to_pylist() for c in batch.columns)):
                place = (block * block_bytes, entry, frames, open_start, open_end)
                rows = _cut_block(data, place, prefix, block_bytes, max_blob_bytes)
                yield piece_batch([name] * len(rows), rows, conn, batch.schema.field(0).type)

    found = blocks.select(conn, "block", "start", "bytes").mapInArrow(
        find, f"`{conn}` {conn_type}, block long, full_to long, {_CHAINS}"
    )
    followed = found.repartition(conn).sortWithinPartitions(conn, "block").mapInArrow(
        follow,
        f"`{conn}` {conn_type}, block long, entry long, frames long, open_start long, open_end long, lost boolean",
    )
    unresolved = followed.filter("lost").select(conn)
    entries = followed.join(unresolved, conn, "left_anti").drop("lost")
    pieces = (
        blocks.select(conn, "block", "bytes")
        .join(entries, [conn, "block"])
        .select(conn, "block", "bytes", "entry", "frames", "open_start", "open_end")
        .mapInArrow(cut, f"`{conn}` {conn_type}, {FrameCutter.SCHEMA}")
    )
    return pieces, unresolved


def _cut_block(data: bytes, place: tuple, prefix: int, block_bytes: int, max_blob_bytes: int | None) -> list[tuple]:
    base, entry, frames, open_start, open_end = place
    own = min(len(data), block_bytes)
    rows: list[tuple] = [(0, "F", 0, None, None, None)] if base == 0 else []
    if open_start is not None:
        begin, end = max(open_start + prefix, base), min(open_end, base + own)
        # A payload too large for a cell is not gathered; its length is known from its first piece.
        oversize = max_blob_bytes is not None and open_end - open_start > max_blob_bytes + MAX_HEADER_BYTES + prefix
        if end > begin:
            length = open_end - open_start if oversize else None
            rows.append((frames - 1, "D", begin - open_start - prefix, None, length, data[begin - base : end - base]))
    if entry is None:
        return rows
    at = entry - base
    while at <= len(data) - prefix and at < own:
        header_len, payload_len = struct.unpack_from(LENGTHS, data, at + prefix - LENGTHS_BYTES)
        rows.append((frames, "F", 0, header_len, payload_len, None))
        begin, following = at + prefix, at + prefix + header_len + payload_len
        if min(following, own) > begin:
            rows.append((frames, "D", 0, header_len, payload_len, data[begin : min(following, own)]))
        frames, at = frames + 1, following
    return rows
