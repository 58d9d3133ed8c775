"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a linear model that is also given the probabilities of the
categories before it; in training these are out-of-fold predictions. The labels at hand only say toxic or not, so the
categories before ``toxic``, which decides, are the kinds of toxic texts in the sample: ``KINDS`` clusters of what they
use, such as words of one language. Terms are words and beginnings of words, as slurs come inflected; the models see those
whose presence speaks most for a toxic text in the sample, rare ones too, each by itself and all by number and share.

The sample has at most ``SAMPLE_DOCS`` labelled documents, half of each kind, those with the smallest hashes of their
doc_id; copies of a text count once. Everything else sees all words of all documents. Words are runs of letters and
digits, A-Z lower-cased. Without labels of both kinds, or if no two toxic texts of the sample share a term that speaks
for them, ``train`` gives None and nothing is toxic. Null and empty texts are not toxic; repeated rows are judged alike;
extra columns, whatever their names, are passed on by ``drop_toxic``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import LOWER, SMALL_SLICE_BYTES, byte_table, mapped, mixed, owners, runs

SAMPLE_DOCS = 4000
#: Terms the models see, and how many of the best they are chosen from: terms found in the same texts count once.
VOCABULARY = 256
CANDIDATES = 2048
#: Beginnings of words that are terms, in bytes.
BEGINNINGS = (3, 4, 5, 6)
#: A term speaks for toxic texts if it is in two of them and, in log-odds, so much more often there than in the others.
MIN_LOG_ODDS = 1.0
KINDS = 3
FOLDS = 5
CHAIN = (*(f"kind_{k}" for k in range(KINDS)), "toxic")
THRESHOLD = 0.5
RIDGE = 0.3
_WORD = byte_table([*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)])


def _terms(data, borders, state) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of terms, the text of each, and how many words each text has."""
    starts, ends, first = runs(data, borders, _WORD)
    data, text = LOWER[data], owners(first)
    longer = [ends - starts > k for k in BEGINNINGS]
    begin = np.concatenate([starts, *(starts[w] for w in longer)])
    end = np.concatenate([ends, *(starts[w] + k for w, k in zip(longer, BEGINNINGS))])
    hashes = state["hasher"].of_bytes(data, begin, end)
    hashes[: len(starts)] = mixed(hashes[: len(starts)] + np.uint64(1))
    return hashes.view(np.int64), np.concatenate([text, *(text[w] for w in longer)]), np.diff(first)


def sample(documents: DataFrame, labels: DataFrame, docs: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``docs`` labelled texts, ``toxic, text``."""
    rule = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    halves = [rule.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(docs // 2) for t in (0, 1)]
    # Bounded by its parameter, and so is its broadcast.
    chosen = F.broadcast(halves[0].unionByName(halves[1]))
    found = documents.select("doc_id", "text").filter(F.col("text").isNotNull()).join(chosen, "doc_id")
    return found.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def _counts(terms: np.ndarray, text: np.ndarray, n: int, vocabulary: np.ndarray) -> np.ndarray:
    v = len(vocabulary)
    at = np.minimum(np.searchsorted(vocabulary, terms), v - 1)
    hit = vocabulary[at] == terms
    return np.bincount(text[hit] * v + at[hit], minlength=n * v).reshape(n, v)


def features(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per text: presence of each term, then how many different ones, all of them, and their share of all words."""
    present, total = counts > 0, counts.sum(1)
    return np.column_stack((present, np.log1p(present.sum(1)), np.log1p(total), np.sqrt(total / np.maximum(words, 1))))


def kinds_of(x: np.ndarray, kinds: int = KINDS, steps: int = 20) -> np.ndarray:
    """The cluster of each row by direction: k-means from rows far from each other, the fullest first."""
    rows = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = rows[[int(np.argmax(x.sum(1)))]]
    while len(centres) < min(kinds, len(rows)):
        centres = np.vstack((centres, rows[np.argmin((rows @ centres.T).max(1))]))
    for _ in range(steps):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.array([rows[own == k].sum(0) for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return np.argmax(rows @ centres.T, axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Weights (bias last) by Newton steps on the penalised likelihood."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (y - p) - penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(hessian, gradient)
        w += change
        if np.abs(change).max() < 1e-6:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def predict(chain: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """The categories' probabilities, each model seeing those before it."""
    out = np.zeros((len(x), len(chain)))
    for k, w in enumerate(chain):
        out[:, k] = _sigmoid(np.column_stack((x, out[:, :k], np.ones(len(x)))) @ w)
    return out


def fit_chain(x: np.ndarray, categories: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """A model per column of ``categories``; what earlier ones feed to later ones is out of fold."""
    chain, fed = [], np.zeros((len(x), 0))
    for k in range(categories.shape[1]):
        own, y = np.column_stack((x, fed)), categories[:, k]
        chain.append(_logistic(own, y))
        held_out = np.zeros(len(x))
        for fold in range(FOLDS):
            test = folds == fold
            if test.any() and not test.all():
                w = _logistic(own[~test], y[~test])
                held_out[test] = _sigmoid(np.column_stack((own[test], np.ones(test.sum()))) @ w)
        fed = np.column_stack((fed, held_out))
    return chain


def train(documents: DataFrame, labels: DataFrame, docs: int = SAMPLE_DOCS) -> dict | None:
    """The vocabulary and the chain, or None without labels of both kinds or without terms that tell."""
    texts = stored(sample(documents, labels, docs), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None

    def held(batch, data, borders, state):
        terms, text, _ = _terms(data, borders, state)
        pairs = np.unique(np.column_stack((text, terms)), axis=0)
        toxic = np.asarray(batch.column(0))[pairs[:, 0]]
        own, at = np.unique(pairs[:, 1], return_inverse=True)
        bad = np.bincount(at, weights=toxic, minlength=len(own)).astype(np.int64)
        return {"term": pa.array(own), "bad": pa.array(bad), "good": pa.array(np.bincount(at, minlength=len(own)) - bad)}

    terms = mapped(texts.select("toxic", "text"), held, "text", "term long, bad long, good long").groupBy("term").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("good") + 0.5) / (sizes[0] + 1.0))
    telling = terms.filter((F.col("bad") > 1) & (odds > MIN_LOG_ODDS)).orderBy((odds * F.sqrt("bad")).desc(), "term")
    ranked = np.array([r["term"] for r in telling.limit(CANDIDATES).collect()], dtype=np.int64)
    if not len(ranked):
        return None
    candidates = np.sort(ranked)

    def rows(batch, data, borders, state):
        terms, text, words = _terms(data, borders, state)
        counts = np.minimum(_counts(terms, text, batch.num_rows, candidates), 255).astype(np.uint8)
        fold = state["hasher"].of_bytes(data, borders[:-1], borders[1:]) % np.uint64(FOLDS)
        return {
            "toxic": batch.column(0),
            "fold": pa.array(fold.astype(np.int32)),
            "words": pa.array(words),
            "counts": pa.array([r.tobytes() for r in counts], pa.binary()),
        }

    schema = "toxic int, fold int, words long, counts binary"
    found = mapped(texts.select("toxic", "text"), rows, "text", schema).orderBy("fold", "toxic", "words", "counts")
    found = found.limit(docs).collect()
    counts = np.array([np.frombuffer(r["counts"], np.uint8) for r in found])[:, np.searchsorted(candidates, ranked)]
    # Of terms found in the same texts the best one is enough.
    _, best = np.unique(counts > 0, axis=1, return_index=True)
    best = np.sort(best)[:VOCABULARY]
    best = best[np.argsort(ranked[best])]
    x = features(counts[:, best].astype(np.int64), np.array([r["words"] for r in found]))
    toxic, folds = np.array([r["toxic"] for r in found], float), np.array([r["fold"] for r in found])
    kind = np.full(len(x), -1)
    kind[toxic == 1] = kinds_of(x[toxic == 1][:, : len(best)])
    categories = np.column_stack([*(kind == k for k in range(KINDS)), toxic]).astype(float)
    return {"vocabulary": ranked[best], "chain": fit_chain(x, categories, folds)}


def _judged(rows: DataFrame, model: dict | None) -> DataFrame:
    """``rows`` (row, text) with ``p_..`` of each category and ``is_toxic``."""
    names = [f"p_{c}" for c in CHAIN]

    def judge(batch, data, borders, state):
        p = np.zeros((batch.num_rows, len(CHAIN)))
        if model is not None:
            terms, text, words = _terms(data, borders, state)
            p = predict(model["chain"], features(_counts(terms, text, batch.num_rows, model["vocabulary"]), words))
            p[words == 0] = 0
        return {
            "row": batch.column(0),
            "text": batch.column(1),
            **{name: pa.array(p[:, k]) for k, name in enumerate(names)},
            "is_toxic": pa.array(p[:, -1] >= THRESHOLD),
        }

    added = [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("is_toxic", T.BooleanType())]
    return mapped(rows, judge, "text", T.StructType([rows.schema["row"], rows.schema["text"], *added]), SMALL_SLICE_BYTES)


def toxicity(documents: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id``, ``p_..`` of each category and ``is_toxic`` per document."""
    return _judged(documents.select(F.col("doc_id").alias("row"), "text"), model).withColumnRenamed("row", "doc_id").drop("text")


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without those the chain finds toxic."""
    others = [c for c in documents.columns if c != "text"]
    rows = documents.select(F.struct(*others).alias("row"), "text")
    judged = _judged(rows, train(documents, labels)).filter(~F.col("is_toxic"))
    return judged.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in documents.columns))


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    own = documents.select(F.col("doc_id").cast("long"), "text")
    return toxicity(own, train(own, labels))
