"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Pieces have whole lengths from 1 to the capacity, so the packing problem of any corpus is a histogram of at most
``capacity`` counts. On it, Martello and Toth's dominance reduction fixes sets of up to three pieces that are at least as
good as every other set with their largest piece; what is left goes by best fit, longest first. Both treat equal
lengths together, so the plan (patterns with multiplicities) is bounded by the capacity, not by the corpus. Pieces then
find their sequence by their rank among the pieces of their length, numbered side by side on all tasks.

Null or empty text is one piece, the end token alone. Repeated rows are separate documents; equal rows are numbered in
any order, which changes nothing in the rows' values. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import sliced

CAPACITY = 4096
END = 1
#: Parts of words kept by a Python worker with their ids; beyond it forgets them all.
CACHED_PARTS = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _public_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Parts of words that are given to the tokenizer as one text.
_TOGETHER = 256
#: Texts whose words are looked up together.
_SLICE_BYTES = 1 << 22
#: How the vocabulary's file prepares a text. Words are cut here only by a file that says just this.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PARTS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Words of these alone are cut here.
_LATIN = r"\A[\x21-\x7e\x{a1}-\x{ff}]*\z"
_LETTER, _NUMBER, _SIGN = range(3)
#: The kind of each code point up to U+00FF.
_KINDS = np.array([_LETTER if c.isalpha() else _NUMBER if c.isnumeric() else _SIGN for c in map(chr, range(256))], np.uint8)


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it is printed, else one from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printed)
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(others)} | {0x20: " "}


def parts_of_words(words: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words as the pre-tokenizer cuts them, one after the other, and where the parts of each begin in these.

    Latin words are lower-cased and cut, since their parts recur more often than they do; others are one part, unchanged.
    """
    latin = pc.match_substring_regex(words, _LATIN)
    words = pc.if_else(latin, pc.utf8_lower(words), words)
    _, borders, data = words.buffers()
    borders = np.frombuffer(borders, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[: borders[-1]] if data is not None else np.zeros(0, np.uint8)
    kinds = _KINDS[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    # U+0080 to U+00FF are two bytes, the first of them C2 or C3.
    kinds[lead] = kinds[lead + 1] = _KINDS[((raw[lead] & 3) << 6) | (raw[lead + 1] & 0x3F)]
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
    cut[lead + 1] = False
    cut[borders] = True
    # 's, 't, 'm, 'd, 're, 've and 'll are parts where a sign could begin, whatever follows.
    quotes = np.flatnonzero((raw == ord("'")) & cut[:-1])
    after = np.zeros(len(raw) + 2, np.uint8)
    after[: len(raw)] = raw
    first, second = after[quotes + 1], after[quotes + 2]
    room = borders[np.searchsorted(borders, quotes, side="right")] - quotes
    for size, found in (
        (2, np.isin(first, list(b"stmd"))),
        (3, ((first == ord("l")) & (second == ord("l"))) | (((first == ord("r")) | (first == ord("v"))) & (second == ord("e")))),
    ):
        at = quotes[found & (room >= size)]
        cut[at + 1] = False
        cut[at + size] = True
    if pc.all(latin).as_py() is False:
        cut[:-1] &= np.repeat(latin.to_numpy(zero_copy_only=False), np.diff(borders))
        cut[borders] = True
    starts = np.flatnonzero(cut)
    parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), data)
    return parts, np.searchsorted(starts, borders)


def _joined(values: pa.LargeBinaryArray, groups: np.ndarray) -> pa.LargeBinaryArray:
    """Neighbouring values made one: those from each group's border to the next."""
    _, borders, data = values.buffers()
    borders = np.frombuffer(borders, np.int64)[values.offset : values.offset + len(values) + 1][groups]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(groups) - 1, [None, pa.py_buffer(borders.copy()), data])


class WordIds:
    """The ids of words by a tokenizer that never joins over white space, as little-endian uint32 bytes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # What is cut, lower-cased and in byte letters needs the tokenizer's model only.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.cuts = given.get("normalizer") == _NORMALIZER and given.get("pre_tokenizer") == _PRE_TOKENIZER
        self.parts: dict[str, bytes] = {"": b""}

    def _learn(self, new: list[str]) -> None:
        latin = [False] * len(new)
        if self.cuts:
            latin = pc.match_substring_regex(pa.array(new, pa.large_string()), _LATIN).to_pylist()
        ours = [part for part, is_latin in zip(new, latin) if is_latin]
        for low in range(0, len(ours), _TOGETHER):
            self._learn_parts(ours[low : low + _TOGETHER])
        others = [part for part, is_latin in zip(new, latin) if not is_latin]
        if others:
            self._learn_each(others)

    def _learn_each(self, new: list[str]) -> None:
        for part, ids in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False)):
            self.parts[part] = array("I", ids.ids).tobytes()

    def _learn_parts(self, new: list[str]) -> None:
        """Parts that the tokenizer would not cut any further, as one text and by its model alone."""
        text = " ".join(new)
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        encoded = self.model.encode(text, add_special_tokens=False)
        ids = array("I", encoded.ids).tobytes()
        borders = [0, *(4 * (np.flatnonzero(np.diff(np.array(encoded.word_ids))) + 1)).tolist(), len(ids)]
        if len(borders) == len(new) + 1:
            self.parts.update(zip(new, (ids[a:b] for a, b in zip(borders, borders[1:]))))
        else:
            self._learn_each(new)

    def _of_parts(self, parts: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of each of these different parts; those that are new to the worker are learnt together."""
        if len(self.parts) > CACHED_PARTS:
            self.parts = {"": b""}
        asked = parts.to_numpy(zero_copy_only=False).tolist()
        new = [part for part in asked if part not in self.parts]
        if new:
            self._learn(new)
        return pa.array([self.parts[part] for part in asked], pa.large_binary())

    def of_texts(self, data: np.ndarray, borders: np.ndarray) -> pa.LargeBinaryArray:
        """The ids of each text of UTF-8 bytes; different words and different parts are looked up once."""
        texts = pa.LargeStringArray.from_buffers(len(borders) - 1, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(data))
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        if self.cuts:
            parts, first = parts_of_words(words.dictionary)
            parts = parts.dictionary_encode()
            ids = _joined(self._of_parts(parts.dictionary).take(parts.indices), first)
        else:
            ids = self._of_parts(words.dictionary)
        return _joined(ids.take(words.indices), split.offsets.to_numpy())


def _tokenizer(path: str) -> WordIds:
    """One per Python worker, kept for the tasks that follow in it."""
    import tokenizers

    # Tasks are the parallel unit; threads of the library would only contend with them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = tokenizers.__dict__.setdefault("_word_ids", {})
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def token_pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: only documents longer than the capacity are cut."""
    path = path or _public_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _tokenizer(path)
        end = np.array([END], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch, data, borders in sliced(batches, "text", _SLICE_BYTES):
            rows = []
            own = ids.of_texts(data, borders)
            for i, doc in enumerate(batch.column(0).to_pylist()):
                tokens = own[i].as_py() + end
                for k, at in enumerate(range(0, len(tokens), width)):
                    piece = tokens[at : at + width]
                    rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values, kind)
                    for values, kind in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


Pattern = list[tuple[int, int]]


class _Stock:
    """Counts by length, with the lengths in stock in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            del self.lengths[bisect.bisect_left(self.lengths, length)]

    def largest(self, room: int) -> int:
        """The largest length in stock of at most ``room``, or 0."""
        i = bisect.bisect_right(self.lengths, room)
        return self.lengths[i - 1] if i else 0

    def smallest(self, n: int, above: int = 0) -> float:
        """The sum of the ``n`` smallest pieces longer than ``above``; endless if there are fewer."""
        total, i = 0.0, bisect.bisect_right(self.lengths, above)
        while n:
            if i == len(self.lengths):
                return float("inf")
            k = min(n, self.counts[self.lengths[i]])
            total, n, i = total + k * self.lengths[i], n - k, i + 1
        return total

    def best_pair(self, room: int) -> tuple[int, int]:
        """The two pieces with the largest sum within ``room`` (the longer first), or (0, 0)."""
        best, i, j = (0, 0), 0, len(self.lengths) - 1
        while i <= j:
            low, high = self.lengths[i], self.lengths[j]
            if low + high > room:
                j -= 1
            else:
                if (i < j or self.counts[low] > 1) and low + high > sum(best):
                    best = (high, low)
                i += 1
        return best


def reduce_by_dominance(stock: _Stock, capacity: int) -> list[tuple[int, Pattern]]:
    """Fixes, and takes from the stock, sets that dominate every other set with their longest piece."""
    fixed = []
    changed = True
    while changed:
        changed = False
        for j in reversed(list(stock.lengths)):
            while stock.counts.get(j):
                pattern = _dominating(stock, j, capacity - j)
                if pattern is None:
                    break
                need: dict[int, int] = {}
                for w in pattern:
                    need[w] = need.get(w, 0) + 1
                times = min(stock.counts[w] // n for w, n in need.items())
                for w, n in need.items():
                    stock.take(w, n * times)
                fixed.append((times, sorted(need.items(), reverse=True)))
                changed = True
    return fixed


def _dominating(stock: _Stock, j: int, room: int) -> list[int] | None:
    """The set with one piece of length ``j`` that dominates all others, if the criterion finds one."""
    stock.take(j, 1)
    try:
        partner = stock.largest(room)
        if not partner:
            return [j]
        if partner == room or stock.smallest(2) > room:
            return [j, partner]
        if stock.smallest(3) <= room:
            return None
        a, b = stock.best_pair(room)
        if partner >= a + b:
            return [j, partner]
        if a == partner and stock.smallest(2, above=b) > room:
            return [j, a, b]
        return None
    finally:
        if j not in stock.counts:
            bisect.insort(stock.lengths, j)
        stock.counts[j] = stock.counts.get(j, 0) + 1


def best_fit(stock: _Stock, capacity: int) -> list[tuple[int, Pattern]]:
    """Best fit, longest first, on groups of sequences that are filled alike."""
    groups: dict[int, list[tuple[int, Pattern]]] = {}
    rooms: list[int] = []

    def add(room: int, n: int, pattern: Pattern) -> None:
        if n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((n, pattern))

    for w in reversed(list(stock.lengths)):
        left = stock.counts[w]
        while left:
            i = bisect.bisect_left(rooms, w)
            if i < len(rooms):
                room = rooms[i]
                n, pattern = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            else:
                room, pattern = capacity, []
                n = -(-left // (capacity // w))
            each = room // w
            full = min(n, left // each)
            add(room - each * w, full, [*pattern, (w, each)])
            left -= full * each
            if left and full < n:
                add(room - left * w, 1, [*pattern, (w, left)])
                add(room, n - full - 1, pattern)
                left = 0
            else:
                add(room, n - full, pattern)
    return [g for of_room in groups.values() for g in of_room]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``length, rank_from, rank_to, each, sequence_from, at``.

    Pieces of a length with ranks from ``rank_from`` go, ``each`` to a sequence, to the sequences from
    ``sequence_from``, where they begin at ``at``.
    """
    stock = _Stock(counts)
    patterns = reduce_by_dominance(stock, capacity) + best_fit(stock, capacity)
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for n, pattern in patterns:
        at = 0
        for w, each in pattern:
            rows.append((w, used[w], used[w] + n * each, each, sequence, at))
            used[w] += n * each
            at += w * each
        sequence += n
    assert used == counts
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"))
    # At most ``capacity`` rows, so they go to every task, and salts take effect.
    plan = packing_plan({r["length"]: r["n"] for r in counts.collect()}, capacity)
    schema = "length long, rank_from long, rank_to long, each long, sequence_from long, at long"
    plan_table = spark.createDataFrame(plan, schema)
    # About sqrt(n) salts for a length of n pieces: neither a salt nor the salts of a length are many.
    salts = F.greatest(F.lit(1), F.ceil(F.sqrt("n"))).cast("long")
    salted = pieces.join(F.broadcast(counts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("length", "salt").agg(F.count("*").alias("in_salt"))
    sums = sums.select("length", "salt", F.coalesce(F.sum("in_salt").over(before), F.lit(0)).alias("salt_from"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("inside", F.row_number().over(inside) - 1)
        .join(sums, ["length", "salt"])
        .withColumn("rank", F.col("salt_from") + F.col("inside"))
    )
    # The plan is bounded by the capacity: a few patterns per length; its size is checked all the same.
    plan_table = F.broadcast(plan_table) if len(plan) <= 64 * capacity else plan_table
    p = plan_table.withColumnRenamed("length", "plan_length")
    match = (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    k = F.col("rank") - F.col("rank_from")
    return ranked.join(p, match).select(
        *pieces.columns,
        (F.col("sequence_from") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def packed_documents(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All documents in sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return pack(stored(token_pieces(documents, path, capacity), "token-pieces"), capacity)
