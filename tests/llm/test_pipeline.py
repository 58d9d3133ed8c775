"""The registered queries and the pipeline on the smallest tables."""

import math
from collections import Counter

import pyarrow as pa
import pytest
from oracle import duckdb_rows, spark_rows

from pyspark.sql import functions as F

import corpus_pipeline
from flowtables.llm import linededup, mixing, ngramjoin, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    columns, rows = spark_rows(queries.QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duckdb_rows(queries.ORACLES[name], SF_DIR)
    assert columns == expected_columns and rows == expected and rows


def test_stages_do_what_their_operators_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["toxicity"](spark, docs, SF_DIR)
    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, toxicity.train(docs, labels)).filter("is_toxic").collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - toxic
    cut = stage["line_dedup"](spark, docs, SF_DIR)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert {(r["doc_id"], r["text"]) for r in cut.collect()} == {(r["doc_id"], r["text"]) for r in linededup.drop_boilerplate(docs).collect()}
    classes = ngramjoin.similarity_classes(docs, 80, 5).collect()
    one = [r["doc_id"] for r in stage["near_copies"](spark, docs, SF_DIR).collect()]
    assert sorted(one) == sorted({r["doc_id"] for r in classes if r["n_shingles"] == 0 or r["doc_id"] == r["component_id"]})
    mixed = stage["mixing"](spark, docs, SF_DIR)
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.taken_words(docs).collect() if r["size"]}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) <= set(taken)
    assert all(math.floor(t) <= copies[d] <= math.ceil(t) for d, t in taken.items())


def test_pipeline_runs_and_packs_all_that_is_left(spark):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert out
    ends = {}
    for r in out:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in ends.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= 4096


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = ("n_lines", "n_removed", "_lines", "_kept", "_doc_id", "_row", "row", "is_toxic", "p_toxic", "_content", "content", "id", "copies", "_no")
    marked = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, marked, SF_DIR)
        assert out.columns == marked.columns, name
        rows = out.select(*names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"own {c}" for c in names)], name


@pytest.mark.parametrize("own", [None, "2500"])
def test_stages_give_python_small_batches_unless_the_session_sets_its_own(spark, own):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = {k: spark.conf.get(k) for k in corpus_pipeline.BATCHES}
    for k in before:
        spark.conf.unset(k)
    try:
        if own:
            spark.conf.set(name, own)
        docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text", "'en' AS lang", "'a' AS source", "1L AS n_chars")
        dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF_DIR)

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) == int(own or 1000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
