"""The incremental frame reader behind O3, O8 and O35."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa

# Header and payload length, big-endian, the last 12 bytes of the fixed prefix.
LENGTHS = ">iq"
LENGTHS_BYTES = 12


class FrameCutter:
    """Cuts the bytes of one connection into frame pieces as they come.

    It keeps only the unfinished fixed prefix of a frame and counters, never content. Pieces are
    ``(frame_no, part, at, header_len, payload_len, bytes)``. Part ``F`` announces a frame, ``D`` holds bytes of its
    header and payload from place ``at`` on (the header's first byte is at 0), ``X`` a negative length, after which
    nothing more is read. A connection starts with an ``F`` piece without lengths, so that even an empty one leaves
    a trace.
    """

    FIELDS = ("frame_no", "part", "at", "header_len", "payload_len", "bytes")
    ARROW_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    SCHEMA = "frame_no long, part string, at long, header_len long, payload_len long, bytes binary"
    STATE_SCHEMA = "frame_no long, header_len long, payload_len long, left long, pending binary, phase string"

    def __init__(self, prefix: int, state: tuple | None = None):
        self.prefix = prefix
        self.frame_no, self.header_len, self.payload_len, self.left, self.pending, self.phase = state or (
            0, 0, 0, 0, b"", "new",
        )

    def state(self) -> tuple:
        return (self.frame_no, self.header_len, self.payload_len, self.left, self.pending, self.phase)

    def feed(self, data: bytes) -> list[tuple]:
        out: list[tuple] = []
        if self.phase == "new":
            out.append((0, "F", 0, None, None, None))
            self.phase = "prefix"
        used = 0
        while self.phase != "dead":
            if self.phase == "prefix":
                take = min(self.prefix - len(self.pending), len(data) - used)
                self.pending += data[used : used + take]
                used += take
                if len(self.pending) < self.prefix:
                    break
                self._begin(out)
            else:
                take = min(self.left, len(data) - used)
                if take:
                    at = self.header_len + self.payload_len - self.left
                    out.append((self.frame_no, "D", at, self.header_len, self.payload_len, data[used : used + take]))
                    used += take
                    self.left -= take
                if self.left:
                    break
                self.frame_no, self.phase = self.frame_no + 1, "prefix"
        return out

    def _begin(self, out: list[tuple]) -> None:
        self.header_len, self.payload_len = struct.unpack(LENGTHS, self.pending[-LENGTHS_BYTES:])
        self.pending = b""
        bad = self.header_len < 0 or self.payload_len < 0
        part = "X" if bad else "F"
        out.append((self.frame_no, part, 0, self.header_len, self.payload_len, None))
        self.phase, self.left = ("dead", 0) if bad else ("body", self.header_len + self.payload_len)


#: Bytes of a batch that are taken apart at once, but one row at least.
_BATCH_BYTES = 4 << 20


def few_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few bytes: what Python makes of a slice is let go before the next one."""
    for batch in batches:
        n = max(1, batch.num_rows * _BATCH_BYTES // max(batch.nbytes, 1))
        for begin in range(0, batch.num_rows, n):
            yield batch.slice(begin, n)


def piece_batch(names: list, rows: list[tuple], conn: str, conn_type: pa.DataType) -> pa.RecordBatch:
    """Pieces of the named connections as one Arrow batch."""
    columns = list(zip(*rows)) if rows else [()] * len(FrameCutter.FIELDS)
    arrays = [pa.array(names, conn_type)] + [pa.array(c, t) for c, t in zip(columns, FrameCutter.ARROW_TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=[conn, *FrameCutter.FIELDS])
