"""Periodic runs against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from flowtables.llm import periodic


def runs_of(words):
    """Every run by comparing all words with all shifts."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            inside_smaller = any(s <= i and j + q <= s + length for s, length, _ in out)
            if j > i and j + q - i >= max(6, 4 * q) and not inside_smaller:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    loop = None if doc_id is None else periodic.loop_of(doc_id, len(words))
    if loop:
        a, p = loop
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    found = runs_of(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id,
        len(found),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def repetitive(rng, n):
    words = []
    while len(words) < n:
        unit = [rng.choice(["a", "b", "c", "é", "語"]) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 30]))]
        words += (unit * rng.choice([1, 1, 2, 4, 5, 9]))[: -rng.randrange(3) or None]
    return rng.choice([" ", "\n", "  \t"]).join(words)


@pytest.mark.parametrize("slice_bytes", [1 << 21, 200])
def test_runs_are_those_of_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr("flowtables.llm.textkernel.SLICE_BYTES", slice_bytes)
    rng = random.Random(7)
    rows = [(None, None), (1, None), (2, ""), (3, " \n "), (None, "a b a b a b a b a b"), (10, "x")]
    rows += [(d, repetitive(rng, rng.choice([5, 20, 100, 400]))) for d in range(10, 250)]
    # One word 3,000 times, twice the same row; a long document with a loop of 2,500 words.
    rows += [(900, " ".join(["x"] * 3000))] * 2
    own = [str(rng.randrange(10**6)) for _ in range(2500)]
    rows += [(901, " ".join(["begin"] + own * 5 + ["end"]))]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, runs int, content int")
    got = sorted(map(repr, map(tuple, periodic.periodic_run_digests(df).collect())))
    assert got == sorted(repr(quick(*r)) for r in rows)


def quick(doc_id, text):
    """Brute force is quadratic; of the loop of 2,500 words the answer is known."""
    if doc_id != 901:
        return digests(doc_id, text)
    words = text.split()
    kept = " ".join(words[:2501] + ["end"])
    return (
        901, 1, 1, 12500, 2500, 5000,
        hashlib.sha256(b"1,12500,2500\n").hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_no_documents(spark):
    assert periodic.periodic_run_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_without_the_loop_texts_are_searched_as_they_are(spark):
    df = spark.createDataFrame([(10, "q " + "a b " * 4 + "r")], "doc_id long, text string")
    [row] = periodic.periodic_runs(df).collect()
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 2)]
    assert row["collapsed_sha256"] == hashlib.sha256(b"q a b r").hexdigest()
