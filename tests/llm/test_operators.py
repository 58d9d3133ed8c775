"""The dealt operators against brute force, and their defined cases: nulls, empty texts, repeats, clashing columns."""

import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtables.llm import (
    ann, chat, components, crf, linededup, mixing, ngramjoin, packing, pii, quality, substring, textkernel, toxicity,
)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(rng.choice(["é", "", "ß"]) + f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats within a text, odd white space, nulls and repeated rows."""
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([3, 30, 60, 120, 300])) for _ in range(40)]
    base = prose(rng, 150, 5000)
    passage = prose(rng, 55, 5000)
    for _ in range(12):
        copy = base.split()
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [base] * 5
    texts += [f"{prose(rng, 20, 9000)} {passage}\n {prose(rng, 25, 9000)}" for _ in range(6)]
    texts += [f"{passage} middle {passage}", "a b c", "A b C", "a b c d", "one", "", "  \t\n ", None, None, " x y z\x0bq"]
    texts += ["same " * 200, "x\n\nx\n y \ny", "loop one two " * 30]
    rows = [(i, t, "en", rng.choice(["s1", "s2", "s3", None]), 0) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[50], (None, "null id " * 3, None, "s1", None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3).cache()


def result(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# 1


def test_chat_round_trip_and_defined_cases(spark):
    rows = [
        (1, 1, "assistant", "\\### Assistant: </turn> ok"), (1, 0, "user", "a\\b<\\l#h\n</turn>\n### user: x"), (1, 2, "user", None),
        (2, 0, "we: ird\\#<", "no reply"), (3, 0, "assistant", ""), (3, 1, "assistant", "ünï"), (3, 1, "assistant", "ünï"),
        (None, None, None, None), (4, 0, "system", ""),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat.conversation_digests(turns).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = chat.explode_examples(chat.format_conversations(turns)).filter("conv_id = 3").orderBy("example").collect()
    assert [e["example"] for e in examples] == [0, 1, 2]
    assert examples[2]["text"].startswith(examples[1]["text"]) and examples[1]["text"][examples[1]["loss_begin"] : examples[1]["loss_end"]] == "ünï"
    assert chat.conversation_digests(turns.limit(0)).count() == 0


# 2


def base_counts(text):
    w = words(text)
    grams = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def test_quality_base_counts(docs, corpus):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = result(quality.quality_rules(docs.withColumn("kept", F.lit(1)), None), *columns)
    assert got == sorted(((r[0], *base_counts(r[1])) for r in corpus), key=repr)


def test_quality_learns_from_whole_documents(spark):
    """Bad documents begin like good ones for longer than a chain; what tells them comes after it."""
    rng = random.Random(12)

    def lines(n):
        return [prose(rng, 12).capitalize() + "." for _ in range(n)]

    rows = []
    for i in range(80):
        junk = ["CLICK | HERE !!! | 12 | 34 | >>>" for _ in range(140)]
        rows.append((i, "\n".join(lines(50) + (lines(140) if i % 2 else junk)), i % 2))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    weights = quality.train(table, table.filter("doc_id < 40"))
    share = {r["doc_id"]: r["content_share"] for r in quality.quality_rules(table, weights).collect()}
    assert min(share[i] for i in range(41, 80, 2)) > 0.9 > 0.5 > max(share[i] for i in range(40, 80, 2))


def test_quality_field_tells_boilerplate(spark):
    rng = random.Random(3)
    good = [(i, "\n".join(prose(rng, 12) + "." for _ in range(6)), 1) for i in range(60)]
    bad = [(100 + i, "\n".join(" | ".join("$$" + prose(rng, 1) for _ in range(12)) for _ in range(6)), 0) for i in range(60)]
    table = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    weights = quality.train(table, table.filter("doc_id % 2 = 0").select("doc_id", "quality"))
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(table, weights).collect()}
    wrong = sum(kept[i] != bool(q) for i, _, q in good + bad if i % 2)
    assert wrong <= 2
    assert quality.train(table, table.filter("quality = 1")) is None
    assert quality.train(table.limit(0), table.limit(0)) is None


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    sizes = [1, 4, 2, 5, 3]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores, start, step, end = rng.normal(size=(15, 3)), rng.normal(size=3), rng.normal(size=(3, 3)), rng.normal(size=3)
    labels = crf.viterbi(scores, first, start, step, end)
    import itertools

    for a, b in zip(first[:-1], first[1:]):
        def total(path):
            return start[path[0]] + end[path[-1]] + sum(scores[a + i, y] for i, y in enumerate(path)) + sum(step[x, y] for x, y in zip(path, path[1:]))

        assert tuple(labels[a:b]) == max(itertools.product(range(3), repeat=b - a), key=total)


# 3


def brute_lines(rows, min_sites):
    sites, first = {}, {}
    for doc, text, _, source, _ in rows:
        for p, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r")
            if line:
                sites.setdefault(line, set()).update([source] if source is not None else [])
                key = (doc is not None, doc, p)
                first[line] = min(first.get(line, key), key)
    bad = {x for x, s in sites.items() if len(s) >= min_sites}
    out = []
    for doc, text, _, _, _ in rows:
        if text is None:
            out.append((doc, None))
            continue
        parts = text.split("\n")
        out.append((doc, "\n".join(x for p, x in enumerate(parts) if x.strip(" \t\r") not in bad or first[x.strip(" \t\r")] == (doc is not None, doc, p))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [2, 7])
def test_line_dedup(spark, min_sites):
    rng = random.Random(8)
    lines = [f"line {i}" for i in range(30)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(6))), "en", f"s{rng.randrange(12)}", 0) for i in range(60)]
    rows += [rows[0], (70, None, None, None, None), (None, "line 1\nline 2", None, None, None), (71, "\tline 1 \n\nline 1", None, "s0", 1)]
    table = spark.createDataFrame(rows, DOCS).withColumn("first", F.lit(1))
    out = linededup.drop_boilerplate(table, min_sites)
    assert result(out, "doc_id", "text") == brute_lines(rows, min_sites)
    assert set(out.columns) == {*table.columns, "n_lines", "n_removed"}
    assert linededup.drop_boilerplate(table.limit(0)).count() == 0


# 4


def test_packing_pieces_and_places(docs, corpus):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing._public_path())
    capacity = 64
    out = packing.packed_documents(docs.withColumn("length", F.lit("clash")), capacity=capacity).collect()
    expected = []
    for doc, text, *_ in corpus:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= math.ceil(sum(r["length"] for r in out) / capacity) + 1
    assert packing.packed_documents(docs.limit(0)).count() == 0


def _ids_of(word_ids, texts):
    """The ids of texts by ``packing.WordIds``, as lists of numbers."""
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    borders = np.cumsum([0, *(len(t.encode()) for t in texts)])
    return [np.frombuffer(i, "<u4").tolist() for i in word_ids.of_texts(data, borders).to_pylist()]


def test_packing_cuts_words_as_the_tokenizer_does():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing._public_path())
    t.encode_special_tokens = True
    rng = np.random.default_rng(5)
    letters = [*map(chr, range(0x21, 0x100)), *"stmdrvleSLD 12 ..\n\t", *["'", " "] * 20]
    letters += ["\u0301", "\u212a", "\u4e2d", "\U0001f600", "\u2003", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    texts += ["", " ", "\n", "'", "'s", "''s", "a's'sam'LL've're'", "1234 a1b2"]
    texts += ["\xaa\xba\xb5\xb2\xbc\xd7\xf7\xad\xdf\xff\xc9\x85\xa0 \x1c\x7f"]
    word_ids = packing.WordIds(packing._public_path())
    for group in (texts, texts[::-1], [""], ["", ""], [" \n"], ["\u4e2d"]):
        assert _ids_of(word_ids, group) == [e.ids for e in t.encode_batch(group, add_special_tokens=False)]


def test_packing_gives_the_tokenizer_each_latin_part_once_and_to_its_model_only():
    word_ids = packing.WordIds(packing._public_path())
    word_ids.tokenizer = None
    texts = ["The caf\xe9's Caf\xe9, the caf\xe9; 42***", "the CAF\xc9. 'Ll"] * 50
    model, asked = word_ids.model, []

    class Model:
        def encode(self, text, **how):
            asked.extend(text.split(" "))
            return model.encode(text, **how)

    word_ids.model = Model()
    first = _ids_of(word_ids, texts)
    assert len(asked) == len(set(asked)) == 10
    assert _ids_of(word_ids, texts) == first and len(asked) == 10


@pytest.mark.parametrize("key", ["normalizer", "pre_tokenizer"])
def test_packing_by_a_vocabulary_that_cuts_otherwise(key, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    with open(packing._public_path(), encoding="utf-8") as file:
        given = json.load(file)
    given[key][key.replace("_", "") + "s"].pop(0)
    if key == "pre_tokenizer":
        given[key]["pretokenizers"].insert(0, {"type": "WhitespaceSplit"})
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(given, file)
    monkeypatch.setattr(packing, "CACHED_PARTS", 3)
    texts = ["It's A caf\xe9, cafe\u0301!", "", "Twice  twice\n1234 \u4e2d\u6587"]
    t, word_ids = Tokenizer.from_file(path), packing.WordIds(path)
    for _ in range(2):
        assert _ids_of(word_ids, texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_packing_plan_is_as_good_as_the_best():
    def fewest(items, capacity):
        best = len(items)

        def place(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for k in sorted(set(bins)):
                if k + items[i] <= capacity:
                    rest = list(bins)
                    rest.remove(k)
                    place(i + 1, [*rest, k + items[i]])
            place(i + 1, [*bins, items[i]])

        place(0, [])
        return best

    rng = random.Random(2)
    off = 0
    for _ in range(60):
        capacity = rng.choice([10, 13, 20])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {}
        for w in items:
            counts[w] = counts.get(w, 0) + 1
        stock = packing._Stock(counts)
        fixed = packing.reduce_by_dominance(stock, capacity)
        rest = [w for w, n in stock.counts.items() for _ in range(n)]
        # What dominance fixes never costs a sequence.
        assert sum(n for n, _ in fixed) + fewest(sorted(rest, reverse=True), capacity) == fewest(items, capacity)
        off += sum(n for n, _ in fixed + packing.best_fit(stock, capacity)) - fewest(items, capacity)
    assert off <= 3


# 5


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(4)
    bad_words = ["zorg", "blarg", "frink", "quux"]
    rows = []
    for i in range(400):
        text, toxic = prose(rng, rng.randrange(20, 200)).split(), i % 3 == 0
        for _ in range(rng.randrange(2, 9) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad_words).capitalize() + rng.choice(["", ".", ","]))
        rows.append((i, " ".join(text), int(toxic)))
    table = spark.createDataFrame([*rows, (1000, None, 0), (1001, "", 1), (None, "zorg blarg frink", None)], "doc_id long, text string, toxic int")
    table = table.withColumn("is_toxic", F.lit("clash"))
    model = toxicity.train(table, table.filter("doc_id % 2 = 0").select("doc_id", "toxic"))
    got = {r["doc_id"]: r["is_toxic"] for r in toxicity.toxicity(table, model).collect()}
    assert sum(got[i] != bool(t) for i, _, t in rows if i % 2) <= 2
    assert not got[1000] and not got[1001] and got[None]
    kept = toxicity.drop_toxic(table, table.select("doc_id", "toxic"))
    assert kept.columns == table.columns and kept.filter("doc_id = 3").count() == 0
    assert set(r["is_toxic"] for r in kept.collect()) == {"clash"}
    assert toxicity.drop_toxic(table.limit(0), table.limit(0)).count() == 0


def test_toxicity_kinds_are_those_of_the_texts_and_forms_of_slurs_are_found(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        text = prose(rng, 60).split()
        if i % 3 == 0:  # two kinds, each with slurs of many forms
            stem = ("vequ", "lowei", "blargu")[i // 3 % 3]
            for _ in range(3):
                text.insert(rng.randrange(len(text)), stem + "".join(rng.choice("abcdefgh") for _ in range(4)))
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(table, table.filter("doc_id % 2 = 0"))
    got = {r["doc_id"]: r for r in toxicity.toxicity(table, model).collect()}
    assert sum(got[i]["is_toxic"] != bool(t) for i, _, t in rows if i % 2) <= 3
    kinds = {i: max(range(toxicity.KINDS), key=lambda k: got[i][f"p_kind_{k}"]) for i, _, t in rows if t and i % 2}
    for stem in range(3):
        own = [k for i, k in kinds.items() if i // 3 % 3 == stem]
        assert max(map(own.count, own)) >= 0.95 * len(own)
    assert len(set(kinds.values())) == 3


def test_toxicity_without_evidence_finds_nothing(spark):
    table = spark.createDataFrame([(i, f"word{i} text", i % 2) for i in range(2)], "doc_id long, text string, toxic int")
    assert toxicity.train(table, table) is None
    assert toxicity.train(table, table.filter("toxic = 1")) is None
    assert [r["is_toxic"] for r in toxicity.toxicity(table, None).collect()] == [False, False]


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter("doc_id % 3 <> 0"))
    held_out = toxicity.toxicity(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    found = {r["toxic"]: (r["n"], r["hits"]) for r in held_out.groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum(F.col("is_toxic").cast("int")).alias("hits")).collect()}
    print("held out, toxic and clean:", found[1], found[0])
    assert found[1][1] >= 0.8 * found[1][0] and found[0][1] <= 0.005 * found[0][0]


# 6


def brute_spans(rows, size):
    at = {}
    split = [words(r[1]) for r in rows]
    for d, w in enumerate(split):
        for i in range(len(w) - size + 1):
            at.setdefault(tuple(w[i : i + size]), []).append((d, i))
    gone = [set() for _ in rows]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + size))
    return sorted(
        (
            (r[0], len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest())
            for r, w, g in zip(rows, split, gone)
        ),
        key=repr,
    )


@pytest.mark.parametrize("size,k", [(35, 8), (9, 4), (12, 5)])
def test_substring_dedup(docs, corpus, size, k):
    got = result(substring.substring_dedup(docs.withColumn("content", F.lit("x")), size, k), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_spans(corpus, size)


def test_substring_dedup_of_branching_texts(spark):
    rng = random.Random(9)
    # Few words and many splices: branches everywhere.
    pool = [f"{a}{b}" for a in "abc" for b in "xyz"]
    stock = [" ".join(rng.choice(pool) for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(stock).split()
            a = rng.randrange(len(own))
            parts += own[a : a + rng.randrange(5, 50)]
        rows.append((i, " ".join(parts), None, None, None))
    got = result(substring.substring_dedup(spark.createDataFrame(rows, DOCS), 10, 4), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_spans(rows, 10)
    assert substring.substring_dedup(spark.createDataFrame([], DOCS)).count() == 0


# 7

_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in _BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a", "b.c", "@", "@x.y", "1", "22", "333", "4444", ".", "-", " ", "+", "(", "é", "4111111111111111", "10.0.0.1", "a@b.co", "\n", "256.1.1.1"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data_field_finds_what_the_base_misses(spark):
    """Secrets in whole documents, of kinds that the labelled table shows with other values."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    secret = re.compile(r'(?i)token = "([0-9a-f]{40})"|(AKIA[A-Z0-9]{16})|password=([0-9a-f]{8,})')
    wanted = {r["doc_id"]: [m.group(m.lastindex) for m in secret.finditer(r["text"] or "")] for r in docs.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    holders = [d for d, values in wanted.items() if values]
    caught = 0
    for d in holders:
        spans = [s.split(":") for s in found[d]["spans"].split(",") if s.startswith("secret")]
        caught += set(wanted[d]) <= {texts[d][int(a) : int(b)] for _, a, b in spans}
    assert len(holders) > 100 and caught >= 0.95 * len(holders)
    clean = [d for d, values in wanted.items() if not values]
    assert sum(found[d]["n_added"] > 0 for d in clean) <= 0.002 * len(clean)


def test_personal_data_with_a_table_of_labels(spark):
    rows = [(f"the badge [secret:BADGE-{n}x{n}y{n}] of guest {n}",) for n in range(1000, 1040)]
    rows += [(f"room {n} has {n} seats since {n}",) for n in range(40)] + [(None,)]
    weights = pii.train(spark.createDataFrame(rows, "marked string"))
    table = spark.createDataFrame([(1, "badge BADGE-7777x1y2 in room 12")], "doc_id long, text string")
    [row] = pii.find_personal_data(table, weights).collect()
    assert (row["n_secret"], row["spans"]) == (1, "secret:6:20")


def test_personal_data(spark):
    rows = [
        (1, "Ünï mail a.b@c.example.org, call +1 (212) 555-0147 or (415) 555-0199.", 1, 0, 0, 1),
        (2, "clean text, chapter 4, version 2.0 of 1999 and 12 more", 0, 0, 0, 0),
        (3, None, 0, 0, 0, 0), (4, "", 0, 0, 0, 0), (4, "", 0, 0, 0, 0), (None, "host 10.1.2.3 card 4111 1111 1111 1111", 0, 1, 1, 0),
    ]
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("spans", F.lit(3))
    got = pii.find_personal_data(table).collect()
    assert sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) for r in got), key=repr) == sorted(
        ((r[0], *r[2:]) for r in rows), key=repr
    )
    by_id = {r["doc_id"]: r for r in got}
    added = rows[0][1].index("(415)")
    assert by_id[2]["spans"] == "" and f"phone:{added}:{added + 14}" in by_id[1]["spans"]
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(rows[0][1]))
    assert by_id[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


# 8


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, (900, 1))
    x[100:160] = x[7]
    rows = [(i, [float(f) for f in np.float32(v)]) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [1.0]), (None, rows[0][1]), rows[5]]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = {}
    for r in ann.search(table).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    full = np.array([r[1] for r in rows])
    hits = total = 0
    assert set(got) == set(range(0, 900, 20))
    for q, found in got.items():
        scores = np.zeros(len(full))
        for d in range(16):
            scores += full[q, d] * full[:, d]
        order = [i for i in np.lexsort((np.arange(len(full)), -scores)) if i != q][:20]
        assert all(scores[i] == s for i, s in found) and len(found) == 20
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits, total = hits + len({i for i, _ in found} & set(order)), total + 20
    assert hits / total >= 0.9
    assert ann.search(table.limit(0)).count() == 0
    assert ann.search(table.filter("vec_id in (0, 20, 21)")).count() == 4


def test_visited_lists_are_not_broadcast(spark):
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))], "vec_id long, embedding array<double>")
    plan = ann.search(table)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [list_id" in plan  # whatever the size that Spark reads off the files


def test_the_sample_of_the_index_has_the_smallest_hashes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    ids = [i % 290 for i in range(300)]  # some ids come twice, with other vectors
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, v array<double>").repartition(5)
    hashed = table.select(F.xxhash64("vec_id").alias("h"), "vec_id", F.xxhash64("v").alias("g"), "v").collect()
    monkeypatch.setattr(ann, "SAMPLE", 40)
    index = ann.Index(table)
    expected = [r["v"] for r in sorted(hashed, key=lambda r: (r["h"], r["vec_id"], r["g"]))[:40]]
    assert index.n == 300 and np.array_equal(index.centroids, ann.balanced_centroids(index.lifted(np.array(expected)), 300 // ann.LIST_SIZE))


# 9


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        target.update({s: 3 * sizes[s] for s in over})
        free -= over
    return target


def test_mixing(spark, corpus):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 400)), "en", rng.choice(["a", "b", "c", "d", "z"]), 0) for i in range(300)]
    rows += [(900, "tiny source", "en", "t", 0), *corpus]
    table = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash"))
    out = mixing.taken_words(table).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(((r["doc_id"], r["size"]) for r in out), key=repr) == sorted(((r[0], len(words(r[1]))) for r in rows), key=repr)
    sizes, taken = {}, {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for source, target in targets(sizes).items():
        row = next(r for r in out if r["source"] == source)
        assert row["source_size"] == sizes[source] and row["target"] == pytest.approx(target)
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK
    again = mixing.taken_words(table.repartition(5)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    assert mixing.taken_words(table.limit(0)).count() == 0
    assert mixing.mixed_documents(table.limit(0)).count() == 0
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    # A document's copies are taken / size, rounded up or down, and sums of words are kept but for a group's longest text.
    copies, words_of = {}, {}
    for r in mixed.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
        words_of[r["source"]] = words_of.get(r["source"], 0) + len(words(r["text"]))
    expected = {}
    for r in out:
        expected.setdefault(r["doc_id"], []).append(r["taken"] / r["size"] if r["size"] else 0)
    for doc_id, n in copies.items():
        assert sum(map(math.floor, expected[doc_id])) <= n <= sum(map(math.ceil, expected[doc_id]))
    for source, n in sizes.items():
        groups = math.ceil(math.sqrt(sum(r["source"] == source for r in out)))
        longest = max(r["size"] for r in out if r["source"] == source)
        assert abs(words_of.get(source, 0) - taken[source]) <= groups * longest


def test_shards_draw_sources_as_a_multinomial_does(spark):
    shares = (0.5, 0.25, 0.15, 0.07, 0.03)
    n, shard_slots = 200 * 512, 512
    rows, begin = [], 0
    for number, share in enumerate(shares):
        rows.append((number, 1000 + number, round(n * share), begin))
        begin += round(n * share)
    rows.append((9, 5, 0, begin))
    plan = spark.createDataFrame(rows, "source_no long, n_blocks long, n_slots long, slot_from long")
    slots = mixing.deal_slots(plan, n, shard_slots)
    assert {tuple(r) for r in slots.groupBy("source_no").agg(F.count("*"), F.min("k"), F.max("k")).collect()} == {
        (number, total, 0, total - 1) for number, _, total, _ in rows if total
    }
    counts = np.zeros((200, 5))
    for r in slots.groupBy("shard", "source_no").count().collect():
        counts[r["shard"], r["source_no"]] = r["count"]
    wanted = np.array(shares) * shard_slots
    assert 0.7 < ((counts - wanted) ** 2 / wanted).sum() / (199 * 4) < 1.4
    assert abs(counts.sum(axis=1) - shard_slots).max() < 40


def test_permutations_are_permutations_and_look_random(spark):
    for n in (1, 2, 3, 1000, 4097):
        at = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit(1)).alias("at"))
        assert sorted(r["at"] for r in at.collect()) == list(range(n))
    n = 100_000
    key = (F.lit(7), F.lit(0))
    at = np.array([r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), *key)).collect()])
    # Where the first twentieth of all indices comes to, in 200 stretches: a hypergeometric draw.
    seen = np.bincount(at[: n // 20] // (n // 200), minlength=200)
    assert 0.7 < ((seen - 25) ** 2 / 25).sum() / 199 / 0.95 < 1.4
    other = np.array([r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(7), F.lit(1))).collect()])
    assert (at == other).mean() < 0.001


def test_mixed_documents_keep_columns_of_any_name(spark):
    rows = [(i % 7, prose(random.Random(i % 5), 40), "ab"[i % 2], i) for i in range(40)]
    schema = "doc_id long, text string, source string, copies int"
    table = spark.createDataFrame(rows, schema).withColumns(
        {c: F.col("copies") for c in ("_no", "_doc_id", "row", "no", "content", "_taken", "target")}
    ).withColumn("kinds", F.create_map(F.lit("a"), "copies"))
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    first = sorted(map(repr, mixed.collect()))
    assert first and first == sorted(map(repr, mixing.mixed_documents(table.repartition(7)).collect()))


def test_mixed_documents_meet_the_targets(spark):
    rng = random.Random(8)
    # Of many blocks each: all documents of a source have about its target / size, which is 15/8, 6/8 and 3/8.
    rows = [(i, prose(rng, rng.randrange(400, 1000)), "en", "abc"[i % 3], 0) for i in range(600)]
    table = spark.createDataFrame(rows, DOCS)
    sizes, mixed, copies = dict.fromkeys("abc", 0), dict.fromkeys("abc", 0), {}
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    out = mixing.mixed_documents(table).collect()
    for r in out:
        mixed[r["source"]] += len(words(r["text"]))
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= mixing.CAP
    for source, target in targets(sizes).items():
        assert mixed[source] == pytest.approx(target, rel=0.05)
    assert sorted(map(repr, mixing.mixed_documents(table.repartition(5)).collect())) == sorted(map(repr, out))


def test_slots_take_every_block_once_per_pass(spark, docs):
    own, slots = mixing.mix(docs)
    for r in slots.groupBy("source_no", "epoch", "block_no").count().collect():
        assert r["count"] == 1
    pieces = mixing.output_pieces(own, slots).groupBy("shard", "slot").agg(F.sum("n_words").alias("n")).collect()
    assert all(0 < p["n"] <= mixing.BLOCK for p in pieces)


# 10


def brute_classes(rows, percent, size):
    sets = []
    for r in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(r[1])]
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(top(i), r[0])) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("percent,size", [(85, 4), (40, 2), (80, 5)])
def test_ngram_join(docs, corpus, percent, size):
    out = ngramjoin.similarity_classes(docs.withColumn("class", F.lit("x")), percent, size)
    assert result(out, "doc_id", "n_shingles", "component_id") == brute_classes(corpus, percent, size)


def test_ngram_join_of_chains_and_empty_tables(spark):
    rng = random.Random(12)
    text, rows = [f"t{i}" for i in range(40)], []
    # Each text differs a little from the one before, so ends of the chain are linked through its middle only.
    for i in range(40):
        text[rng.randrange(40)] = f"n{i}"
        rows.append((i, " ".join(text), None, None, None))
    rng.shuffle(rows)
    out = ngramjoin.similarity_classes(spark.createDataFrame(rows, DOCS), 70, 3)
    assert result(out, "doc_id", "n_shingles", "component_id") == brute_classes(rows, 70, 3)
    empty = spark.createDataFrame([], DOCS)
    assert ngramjoin.similarity_classes(empty).count() == 0 and ngramjoin.one_of_each(empty).count() == 0


def test_ngram_join_of_copies_behind_a_quoting_centre(spark):
    # The first text is the centre of all that its two near copies share, and too long for both; its passage is in others.
    def run(kind, n):
        return " ".join(f"{kind}1x{i}" for i in range(n))

    quoted, passage = run("c", 392), run("p", 200)
    texts = [f"{quoted} {passage}", f"{quoted} {run('u', 8)}", f"{quoted} {run('v', 8)}", *[passage] * 5]
    rows = [(10 + i, t, None, None, None) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, DOCS)
    out = ngramjoin.similarity_classes(table)
    assert result(out, "doc_id", "n_shingles", "component_id") == brute_classes(rows, 85, 4)
    assert {r["doc_id"] for r in ngramjoin.one_of_each(table).collect()} == {10, 11, 13}


def test_one_of_each(docs, corpus):
    kept = sorted((r["doc_id"] for r in ngramjoin.one_of_each(docs).collect()), key=repr)
    classes = brute_classes(corpus, 85, 4)
    assert kept == sorted({d for d, n, c in classes if n == 0 or d == c}, key=repr)


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    group = {x: x for link in links for x in link}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        group[b] = a
    assert got == {x: top(x) for a, b in links if a != b for x in (a, b)}


# Shared arrays


def test_text_kernel():
    texts = ["ab c", "", "  d", "e", "é f  ", "g"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    borders = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    starts, ends, first = textkernel.runs(data, borders, textkernel.WORD)
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert got == [w for t in texts for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    hashes = textkernel.Hasher().of_bytes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(got))


def test_hashing_texts_needs_memory_for_a_small_slice():
    import tracemalloc

    import pyarrow as pa

    from flowtables.llm import textkernel, toxicity

    batch = pa.record_batch([pa.array(["some words of a text " * 50] * 4000)], names=["text"])
    state = {"hasher": textkernel.Hasher()}
    tracemalloc.start()
    for _, data, borders in textkernel.sliced(iter([batch]), "text", textkernel.SMALL_SLICE_BYTES):
        toxicity._terms(data, borders, state)
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("block", [2, 256])
def test_all_links_of_a_near_copy_group_are_counted(spark, monkeypatch, block):
    from flowtables.llm import ngramjoin

    monkeypatch.setattr(ngramjoin, "LINK_BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 40 + 2 * i])) for i in range(10)] + [(20, " ".join(base)), (21, None), (22, " ".join(base[:40])), (23, "a b c")]
    sets = {}
    for i, text in rows:
        words = (text or "").split()
        sets[i] = frozenset(tuple(words[k : k + 4]) for k in range(len(words) - 3)) or frozenset([tuple(words)] if words else [])
    different = set(sets.values()) - {frozenset()}
    expected = {i: sum(100 * len(s & o) >= 85 * len(s | o) for o in different if o != s) if s else 0 for i, s in sets.items()}
    found = ngramjoin.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in found} == expected
    assert max(expected.values()) > 3


@pytest.mark.parametrize("common", [ngramjoin.COMMON_COUNT, 2])
def test_prefixes_are_made_once_and_common_shingles_are_dealt(docs, corpus, monkeypatch, common):
    passes, stored = [], ngramjoin.stored

    def seen(df, name):
        if name == "shared-prefixes":
            passes.append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return stored(df, name)

    monkeypatch.setattr(ngramjoin, "stored", seen)
    monkeypatch.setattr(ngramjoin, "COMMON_COUNT", common)
    monkeypatch.setattr(ngramjoin, "COMMON_PARTS", 3)
    out = ngramjoin.similarity_classes(docs, 80, 5)
    assert result(out, "doc_id", "n_shingles", "component_id") == brute_classes(corpus, 80, 5)
    assert passes == [1]
