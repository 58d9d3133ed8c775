"""Phrase collocations by set-oriented mining of sorted relations (SETM, Houtsma and Swami 1995).

* Words are counted slice by slice of the texts and added up. Frequent words get numbers, and the relation R1 of their
  occurrences is made in a second pass over the texts and written sorted by piece and position, in buckets by piece.
* Rk lists occurrences of frequent phrases of k words: piece, position of the word that comes next, number of the phrase.
  It is merged with R1 by piece and adjacent position (R1 with itself: each row with the next one, by a window), groups of
  phrase and word are counted, and those found often enough get numbers. A second merge, semi-joined with them, is R(k+1),
  written sorted in the same buckets. So relations are never shuffled to be extended, only counts are, after they have been
  added up in each task.
* Frequent phrases are found through their frequent beginnings, hence exactly. Their numbers stand for whole phrases: no
  hashes. Tables of frequent phrases are broadcast while they have at most ``BROADCAST_ROWS`` rows, and shuffled beyond.

Scores, nesting and ranks come from the tables of frequent phrases alone, in decimals of 38 digits.

Texts are lower-cased (A to Z) and split at ``.,;:!?`` and line ends into pieces, and these at blanks and tabs into words.
Phrases do not cross pieces. A null or empty text has no words; a null language is ``und``. Repeated rows count again. An
empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored
from flowtables.llm.textkernel import LOWER, byte_table, runs, sliced
from flowtables.sources.workdir import work_dir

MIN_COUNT = 100
MAX_WORDS = 5
FIRST = 2000
#: More frequent words or phrases than this are joined by shuffling.
BROADCAST_ROWS = 500_000
#: A task adds up its counts of words until it has so many.
COUNTED_WORDS = 1 << 18

_ENDS = byte_table(b".,;:!?\n\v\f\r")
_WORD = byte_table(b" \t.,;:!?\n\v\f\r", inverted=True)


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words of a slice, given its bytes and where they lie."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    letters = data[_WORD[data]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters))
    return words.cast(pa.string())


def _of_words(column: pa.Array, first: np.ndarray) -> pa.Array:
    """Each text's value for each of its words."""
    return column.take(pa.array(np.repeat(np.arange(len(column)), np.diff(first))))


def _langs(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def word_counts(documents: DataFrame) -> DataFrame:
    """``lang, word, a`` of all words."""

    def added(tables: list[pa.Table]) -> pa.Table:
        counts = pa.concat_tables(tables).group_by(["lang", "word"], use_threads=False).aggregate([("a", "sum")])
        return counts.select(["lang", "word", "a_sum"]).rename_columns(["lang", "word", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n_waiting, least = [], 0, 0
        for batch, data, borders in sliced(batches, "text"):
            data = LOWER[data]
            starts, ends, first = runs(data, borders, _WORD)
            lang, word = _of_words(batch.column(0), first), _words(data, starts, ends)
            own = added([pa.table({"lang": lang, "word": word, "a": pa.array(np.ones(len(starts), np.int64))})])
            waiting.append(own)
            n_waiting += own.num_rows
            # Counts of words seen again shrink; tables that hardly do are given away.
            if n_waiting > COUNTED_WORDS + least:
                waiting = [added(waiting)]
                n_waiting = least = waiting[0].num_rows
                if n_waiting > COUNTED_WORDS:
                    yield from waiting.pop().to_batches()
                    n_waiting = least = 0
        if waiting:
            yield from added(waiting).to_batches()

    counts = _langs(documents).mapInArrow(run, "lang string, word string, a long")
    return counts.groupBy("lang", "word").agg(F.sum("a").alias("a"))


def occurrences(documents: DataFrame) -> DataFrame:
    """``piece, pos, lang, word`` for every word. Numbers of pieces are unique, so write this before using it twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece_base = TaskContext.get().partitionId() << 40
        for batch, data, borders in sliced(batches, "text"):
            data = LOWER[data]
            starts, ends, first = runs(data, borders, _WORD)
            if not len(starts):
                continue
            # A word begins a piece if it is the first of its text or a piece's end lies before it.
            ended = np.cumsum(_ENDS[data])[starts]
            opens = np.ones(len(starts), bool)
            opens[1:] = ended[1:] != ended[:-1]
            opens[first[:-1][np.diff(first) > 0]] = True
            piece = np.cumsum(opens) - 1
            begin = np.flatnonzero(opens)
            yield pa.RecordBatch.from_pydict(
                {
                    "piece": pa.array(piece_base + piece),
                    "pos": pa.array((np.arange(len(starts)) - begin[piece]).astype(np.int32)),
                    "lang": _of_words(batch.column(0), first),
                    "word": _words(data, starts, ends),
                }
            )
            piece_base += int(piece[-1]) + 1

    return _langs(documents).mapInArrow(run, "piece long, pos int, lang string, word string")


@contextlib.contextmanager
def _merging_in_place(spark: SparkSession) -> Iterator[None]:
    """Merge joins by piece and position take tables as they lie: in buckets by piece, sorted by both."""
    wanted = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _sorted_relation(df: DataFrame, pos: str, shuffled: bool) -> DataFrame:
    """``df`` written in buckets by piece, each sorted by piece and ``pos``."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"occurrences_{uuid.uuid4().hex}"
    own = df.repartition(buckets, "piece") if shuffled else df
    writer = own.write.bucketBy(buckets, "piece").sortBy("piece", pos).option("path", work_dir(spark, name))
    writer.saveAsTable(name)
    return spark.table(name)


def _numbered(counts: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Groups with ``a`` high enough, written with a number each, and the same marked for the join if few."""
    kept = stored(counts.filter(F.col("a") >= min_count).withColumn("id", F.monotonically_increasing_id()), "frequent")
    return kept, F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def frequent_phrases(documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, a`` of all phrases found ``min_count`` times, single words included, and ``lang, n``."""
    spark = documents.sparkSession
    counts = stored(word_counts(documents), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    words, words_near = _numbered(counts, min_count)
    # Used once, so it need not be written: a table of all words is the largest of all.
    first = occurrences(documents).join(words_near.select("lang", "word", "id"), ["lang", "word"])
    first = first.select("piece", "pos", F.col("id").alias("word_id"))
    phrases = [words.select("id", "lang", F.col("word").alias("phrase"), F.array("word").alias("words"), "a")]
    named = words.select(F.col("id").alias("word_id"), "word")
    with _merging_in_place(spark):
        single = _sorted_relation(first, "pos", shuffled=True)
        # Occurrences of phrases of k words: at is the position of the next word. Of one word, the next row is it.
        place = Window.partitionBy("piece").orderBy("pos")
        following = [F.lead(c).over(place).alias(to) for c, to in (("pos", "at"), ("word_id", "word_id"))]
        longer = single.select("piece", "pos", F.col("word_id").alias("phrase_id"), *following)
        longer = longer.filter("at = pos + 1").select("piece", "at", "phrase_id", "word_id")
        right = single.withColumnRenamed("piece", "_piece")
        for k in range(2, max_words + 1):
            if k > 2:
                longer = own.join(right, (F.col("piece") == F.col("_piece")) & (F.col("at") == F.col("pos")))
                longer = longer.select("piece", "at", "phrase_id", "word_id")
            groups, near = _numbered(longer.groupBy("phrase_id", "word_id").agg(F.count("*").alias("a")), min_count)
            begun = phrases[-1].select(F.col("id").alias("phrase_id"), "lang", "words")
            grown = groups.join(begun, "phrase_id").join(named, "word_id").withColumn("words", F.concat("words", F.array("word")))
            grown = grown.select("id", "lang", F.array_join("words", " ").alias("phrase"), "words", "a")
            phrases.append(stored(grown, "phrases"))
            if k < max_words:
                kept = longer.join(near.select("phrase_id", "word_id", "id"), ["phrase_id", "word_id"])
                kept = kept.select("piece", (F.col("at") + 1).alias("at"), F.col("id").alias("phrase_id"))
                own = _sorted_relation(kept, "at", shuffled=False)
    return functools.reduce(DataFrame.unionByName, phrases).drop("id"), totals


def _part(words: str, begin: str, size: str) -> F.Column:
    return F.expr(f"array_join(slice({words}, {begin}, {size}), ' ')")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score``: each phrase of two words and more at its lowest-scoring cut."""
    counts = phrases.select("lang", "phrase", "a")
    cuts = phrases.filter("size(words) > 1").withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    cuts = cuts.withColumn("left", _part("words", "1", "k")).withColumn("right", _part("words", "k + 1", "size(words) - k"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    wide = "cast({0} as decimal(19, 0))"
    above = f"cast(1000 * a as decimal(19, 0)) * {wide.format('n')}"
    below = f"{wide.format('l')} * {wide.format('r')}"
    cuts = cuts.join(totals, "lang").withColumn("score", F.expr(f"({above}) div ({below})"))
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"),
        F.first("a").alias("a"),
        F.first("n").alias("n"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    return lowest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    documents: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, first: int = FIRST, nested_percent: int = 100
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` of each language.

    A phrase goes if a longer one holds it and has at least ``nested_percent`` of its occurrences.
    """
    phrases, totals = frequent_phrases(documents, min_count, max_words)
    found = stored(scored(phrases, totals), "collocations")
    # All shorter phrases inside each, and the most frequent phrase each is inside of.
    inner = found.filter("size(words) > 2").withColumn("size", F.explode(F.expr("sequence(2, size(words) - 1)")))
    inner = inner.withColumn("begin", F.explode(F.expr("sequence(1, size(words) - size + 1)")))
    inner = inner.select("lang", _part("words", "begin", "size").alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = found.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < nested_percent * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS size, unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: w[i:i + {k - 1}])) AS words FROM pieces WHERE len(w) >= {k}"
    for k in range(1, MAX_WORDS + 1)
)
ORACLE = f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\\n\\x0b\\x0c\\r]')) AS piece
        FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
f AS (SELECT lang, words, count(*) AS a FROM ({_GRAMS}) GROUP BY lang, words HAVING count(*) >= {MIN_COUNT}),
cuts AS (
  SELECT c.lang, c.words, c.a, c.k, x.a AS l, y.a AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1) c
  JOIN f x ON x.lang = c.lang AND x.words = c.words[1:c.k]
  JOIN f y ON y.lang = c.lang AND y.words = c.words[c.k + 1:]
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
around AS (
  SELECT lang, words[b:b + s - 1] AS words, max(a) AS around
  FROM (SELECT *, unnest(range(1, len(words) - s + 2)) AS b
        FROM (SELECT *, unnest(range(2, len(words))) AS s FROM f WHERE len(words) > 2))
  GROUP BY ALL),
kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score
  FROM lowest LEFT JOIN around USING (lang, words) WHERE around IS NULL OR 100 * around < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {FIRST}
"""
