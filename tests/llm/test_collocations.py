"""Collocations against a brute-force version and against their SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from oracle import duckdb_rows, spark_rows

from flowtables.llm import collocations, queries

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, max_words=5, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang or "und", *words[i : i + k]) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= min_count and len(p) > 2}
    out = []
    for (lang, *words), a in frequent.items():
        words = tuple(words)
        around = [
            b for (other, *longer), b in frequent.items()
            if other == lang and len(longer) > len(words) and any(tuple(longer[i : i + len(words)]) == words for i in range(len(longer)))
        ]
        if any(100 * b >= 100 * a for b in around):
            continue
        cut = min((1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words)))
        out.append((lang, -cut[0], -a, " ".join(words).encode(), f[lang, *words[: cut[1]]], f[lang, *words[cut[1] :]], n[lang]))
    ranked = []
    for lang in n:
        own = sorted(r for r in out if r[0] == lang)[:first]
        ranked += [(lang, i + 1, r[3].decode(), -r[2], r[4], r[5], r[6], -r[1]) for i, r in enumerate(own)]
    return sorted(ranked)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [("en", None), ("en", ""), (None, " \t,.;\n"), (None, "Kalte Füße, kalte füße"), ("und", "kalte füße")]
    passage = " ".join(f"p{i}" for i in range(40))
    for i in range(120):
        words = [rng.choice(["the", "The", "of", "é", "zß", "a", "b-c", "x"]) + rng.choice(["", "", ",", "\n", "  ", "."]) for _ in range(30)]
        out.append((rng.choice(["en", "de", None]), rng.choice([" ", "\t", " \x0b"]).join(words) + rng.choice(["", passage])))
    return out + out[7:9] * 4 + [("en", "no end " * 700)]


@pytest.mark.parametrize("near", [collocations.BROADCAST_ROWS, 0])
def test_collocations_are_those_of_brute_force(spark, rows, monkeypatch, near):
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", near)
    monkeypatch.setattr("flowtables.llm.textkernel.SLICE_BYTES", 2000)
    df = spark.createDataFrame([(g, t, 0, "c") for g, t in rows], "lang string, text string, a int, phrase string").repartition(5)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(df, 20).collect())
    assert len(got) > 50
    assert got == brute(rows, 20)
    top = sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(df, 20, first=7).collect())
    assert top == [r for r in got if r[1] <= 7]


def test_no_documents(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_relations_are_extended_without_shuffling_them(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.occurrences(df).select("piece", "pos", "word")
    with collocations._merging_in_place(spark):
        one = collocations._sorted_relation(found, "pos", shuffled=True)
        other = one.select(one.piece.alias("p"), one.pos.alias("q"), "word")
        joined = one.hint("merge").join(other, (one.piece == other.p) & (one.pos == other.q))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "hashpartitioning" not in plan


def test_scores_beyond_64_bits(spark):
    many = 10**13
    phrases = spark.createDataFrame(
        [("en", "a", ["a"], 3 * many), ("en", "b", ["b"], 2 * many), ("en", "a b", ["a", "b"], many + 1)],
        "lang string, phrase string, words array<string>, a long",
    )
    [row] = collocations.scored(phrases, spark.createDataFrame([("en", 9 * many)], "lang string, n long")).collect()
    assert row["score"] == 1000 * (many + 1) * 9 * many // (6 * many * many)


def test_query_agrees_with_sql(spark):
    columns, got = spark_rows(queries.QUERIES["op12_collocations"](spark, SF_DIR))
    expected_columns, expected = duckdb_rows(queries.ORACLES["op12_collocations"], SF_DIR)
    assert columns == expected_columns and got and got == expected


@pytest.mark.parametrize("counted", [collocations.COUNTED_WORDS, 5])
def test_words_are_counted_without_a_table_of_all_words(spark, rows, monkeypatch, counted):
    written, stored = [], collocations.stored
    monkeypatch.setattr(collocations, "COUNTED_WORDS", counted)
    monkeypatch.setattr(collocations, "stored", lambda df, name: written.append(name) or stored(df, name))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    expected = Counter()
    for lang, text in rows:
        expected.update((lang or "und", w) for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", (text or "").translate(LOWER)))
    assert {(r["lang"], r["word"]): r["a"] for r in collocations.word_counts(df).collect()} == expected
    collocations.frequent_phrases(df, 20)
    assert "word-counts" in written and "word-occurrences" not in written
