"""Line dedup by distinct-site spread.

A line's sites are the distinct values of ``source`` of the documents that hold it. HyperLogLog sketches per line hash
are merged by aggregation; a line whose estimate is near the threshold gets an exact distinct count. Lines found on
``min_sites`` sites or more are boilerplate and go from every document but for their first occurrence (smallest doc_id,
then place), so that no text vanishes altogether.

Lines are the pieces between ``\\n`` without spaces and tabs around; blank lines stay. Null text stays null, a null
source is no site. Rows that share a doc_id are cut alike: each keeps the place that was first under that doc_id. Documents
whose lines all go keep their row with an empty text. An empty table gives an empty table; extra columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.scratch import stored

MIN_SITES = 10
#: The sketch has 2 ** LG_K registers.
LG_K = 10
#: Estimates within so many standard errors of the threshold are counted exactly.
NEAR = 6.0


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(documents: DataFrame) -> DataFrame:
    """``doc_id, source, place, line`` (a 64-bit hash) of all lines that are not blank."""
    return (
        documents.select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("place", "text"))
        .select("doc_id", "source", "place", trimmed(F.col("text")).alias("text"))
        .filter(F.col("text") != "")
        .select("doc_id", "source", "place", F.xxhash64("text").alias("line"))
    )


def boilerplate_lines(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line, first``: hashes of the lines on ``min_sites`` sites or more, and where each is found first."""
    lines = _lines(documents)
    # Nearly all lines are on one site; two numbers per line find the others, and only those get a sketch.
    shared = (
        lines.groupBy("line")
        .agg(
            F.min("source").alias("low"),
            F.max("source").alias("high"),
            F.min(F.struct("doc_id", "place")).alias("first"),
        )
        .filter((F.col("low") != F.col("high")) if min_sites > 1 else F.lit(True))
        .select("line", "first")
    )
    shared = stored(shared, "shared-lines")
    # One row per line, site and task reaches the sketches' shuffle, however often a line occurs.
    spread = lines.select("line", "source").join(shared.select("line"), "line", "left_semi")
    error = 1.04 / 2 ** (LG_K / 2)
    estimates = spread.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("source", F.lit(LG_K))).alias("sites")
    )
    estimates = stored(estimates, "line-spread")
    margin = max(1.0, NEAR * error * min_sites)
    near = F.abs(F.col("sites") - min_sites) <= margin
    exact = (
        spread.join(estimates.filter(near).select("line"), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("source").alias("sites"))
    )
    spread_out = (
        estimates.filter(~near).unionByName(exact).filter(F.col("sites") >= min_sites).select("line")
    )
    return shared.join(spread_out, "line", "left_semi")


def drop_boilerplate(documents: DataFrame, min_sites: int = MIN_SITES, counts: bool = True) -> DataFrame:
    """``documents`` with ``text`` cut and, with ``counts``, ``n_lines`` and ``n_removed`` (lines that are not blank).

    Columns of any other names are passed on; without ``counts`` these are, too.
    """
    boilerplate = stored(boilerplate_lines(documents, min_sites), "boilerplate-lines")
    found = _lines(documents.select("doc_id", "text", F.lit(None).cast("string").alias("source")))
    hits = (
        found.join(boilerplate, "line")
        .withColumn("kept", (F.struct("doc_id", "place").eqNullSafe(F.col("first"))))
        .groupBy("doc_id")
        .agg(
            F.collect_set("line").alias("_lines"),
            F.collect_set(F.when(F.col("kept"), F.col("place"))).alias("_kept"),
        )
        .withColumnRenamed("doc_id", "_doc_id")
    )
    hits = stored(hits, "boilerplate-hits")
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    # Columns are packed, so that none can clash with those made here.
    rows = documents.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("_row"))
    # Both sides grow with the corpus: neither is to be sent to every task, however small it is in a trial.
    joined = rows.join(hits.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left")
    goes = lambda x, i: (trimmed(x) != "") & F.array_contains(F.col("_lines"), F.xxhash64(trimmed(x))) & ~F.array_contains(F.col("_kept"), i)
    parts = F.split("text", "\n")
    untouched = F.col("_lines").isNull() | F.col("text").isNull()
    kept = F.filter(parts, lambda x, i: ~goes(x, i))
    filled = F.size(F.filter(parts, lambda x: trimmed(x) != "")).cast("long")
    text = F.when(untouched, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    given = {"text": text, "doc_id": F.col("doc_id")}
    own = [given.get(c, F.col("_row").getField(c).alias(c)) for c in documents.columns if not (counts and c in ("n_lines", "n_removed"))]
    if not counts:
        return joined.select(*own)
    return joined.select(
        *own,
        F.when(F.col("text").isNull(), 0).otherwise(filled).cast("long").alias("n_lines"),
        F.when(untouched, 0).otherwise(F.size(parts) - F.size(kept)).cast("long").alias("n_removed"),
    )


def line_dedup_digests(documents: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    out = drop_boilerplate(documents.select("doc_id", "text", "source"), min_sites)
    return out.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, p, trim(l, ' ' || chr(9) || chr(13)) AS line FROM (
    SELECT doc_id, source, string_split(text, chr(10)) AS ls, unnest(range(len(string_split(text, chr(10))))) AS p,
           unnest(string_split(text, chr(10))) AS l
    FROM documents WHERE text IS NOT NULL)),
bad AS (
  SELECT line, min(ROW(doc_id, p)) AS first FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.p, l.line, b.line IS NOT NULL AND ROW(l.doc_id, l.p) <> b.first AS goes
  FROM lines l LEFT JOIN bad b ON l.line = b.line),
raw AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS p, unnest(string_split(text, chr(10))) AS l
  FROM documents WHERE text IS NOT NULL)
SELECT d.doc_id,
       CAST(coalesce(count(*) FILTER (WHERE m.line <> ''), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(count(*) FILTER (WHERE m.goes), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(r.l, chr(10) ORDER BY r.p) FILTER (WHERE NOT m.goes), '')) AS kept_sha256
FROM documents d LEFT JOIN raw r USING (doc_id) LEFT JOIN marked m ON m.doc_id = d.doc_id AND m.p = r.p
GROUP BY d.doc_id
"""
