"""Repeated strings of bytes against brute force: one transform, split groups, whole documents."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from flowtables.llm import byterepeats, intervals, queries


def brute_starts(texts, weights, length):
    counts = Counter()
    for t, k in zip(texts, weights):
        for i in range(len(t) - length + 1):
            counts[t[i : i + length]] += k
    return [[i + length <= len(t) and counts[t[i : i + length]] > 1 for i in range(len(t))] for t in texts]


def brute_documents(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), t, hits in zip(rows, texts, brute_starts(texts, [1] * len(texts), length)):
        gone = [False] * len(t)
        for i in np.flatnonzero(hits):
            gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(60))
def test_intervals_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 2, 3, 5, 8, 20, 33])
    alphabet = b"ab\x00\xff"[: rng.choice([1, 2, 4])]
    base = bytes(rng.choice(alphabet) for _ in range(rng.choice([5, 60])))
    texts = [
        b"".join(rng.choice([base, base[3:40], bytes(rng.choice(b"abc") for _ in range(9)), b""]) for _ in range(rng.choice([1, 2, 4])))
        for _ in range(rng.choice([1, 2, 5, 12]))
    ]
    weights = [rng.choice([1, 1, 2]) for _ in texts]
    borders = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = intervals.repeated_starts(np.frombuffer(b"".join(texts), np.uint8), borders, np.array(weights), length)
    assert got.tolist() == sum(brute_starts(texts, weights, length), [])


def test_common_prefixes_come_by_increasing_value():
    text = np.frombuffer(b"abracadabra" * 3, np.uint8)
    symbols = np.append(text.astype(np.uint16) + 1, 0).astype(np.uint16)
    order = intervals.suffix_order(symbols, 40)
    suffixes = [symbols[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)
    for length in (1, 4, 12):
        border = intervals.common_prefix_borders(symbols[order - 1], length)
        for i in range(1, len(order)):
            if min(len(suffixes[i]), len(suffixes[i - 1])) > length:
                assert border[i] == (suffixes[i][:length] != suffixes[i - 1][:length])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)

    def noise(n):
        return "".join(rng.choice("abcdefgh é語") for _ in range(n))

    passage, base = noise(90), noise(400)
    out = [(1, None), (2, ""), (3, "x"), (None, noise(30)), (None, noise(30)), (4, "ab" * 200), (5, "z" * 150)]
    # One passage in very many documents, exact copies, near copies, repeats within a text, overlaps.
    out += [(i, noise(rng.choice([0, 5, 40])) + passage + noise(rng.choice([0, 5, 40]))) for i in range(10, 200)]
    out += [(300 + i, base) for i in range(30)]
    for i in range(60):
        at = rng.randrange(380)
        out.append((400 + i, base[:at] + noise(rng.randrange(3)) + base[at + rng.randrange(4) :]))
    own = noise(70)
    out += [(500, own + noise(20) + own), (501, own[:50] + own[20:]), (502, noise(3000)), (300, base)]
    return out + [(600 + i, noise(rng.choice([20, 41, 200]))) for i in range(40)]


@pytest.mark.parametrize(("transform", "block", "slice_bytes"), [(1 << 20, 1 << 22, 1 << 21), (3000, 1 << 22, 5000), (500, 100, 300)])
def test_documents_are_those_of_brute_force(spark, monkeypatch, rows, transform, block, slice_bytes):
    monkeypatch.setattr(byterepeats, "TRANSFORM_BYTES", transform)
    monkeypatch.setattr(byterepeats, "BLOCK", block)
    monkeypatch.setattr("flowtables.llm.textkernel.SLICE_BYTES", slice_bytes)
    df = spark.createDataFrame([(d, t, "clash", 0) for d, t in rows], "doc_id long, text string, begin string, kept int").repartition(3)
    got = byterepeats.byte_dedup(df, length=40, anchor=12)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    collected = got.collect()
    assert sorted((tuple(r[c] for c in columns) for r in collected), key=repr) == brute_documents(rows, 40)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in collected)


def test_no_documents(spark):
    assert byterepeats.byte_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_agrees_with_brute_force(spark):
    """All strings of 200 bytes of the smallest tables."""
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op11_interval_expansion"](spark, sf_dir).collect()), key=repr)
    assert got == brute_documents(rows, 200)
    assert any(r[2] for r in got) and any(r[1] and not r[2] for r in got)
