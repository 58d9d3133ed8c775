"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm import (
    ann, byterepeats, chat, collocations, linededup, mixing, ngramjoin, packing, periodic, pii, quality, substring, toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_prefix_targets(spark, sf_dir):
    """All conversations, and one that tries to break the template."""
    hard = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(turns.unionByName(extra))


def op2_line_field(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return quality.quality_rules(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


def op3_site_spread(spark, sf_dir):
    return linededup.line_dedup_digests(_table(spark, sf_dir, "documents"))


def op4_best_fit(spark, sf_dir):
    return packing.packed_documents(_table(spark, sf_dir, "documents"))


def op5_toxicity_chain(spark, sf_dir):
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_repeated_spans(spark, sf_dir):
    return substring.substring_dedup(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark, sf_dir):
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op8_posting_lists(spark, sf_dir):
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op9_source_mix(spark, sf_dir):
    taken = mixing.taken_words(_table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "first_shard")


def op10_ngram_join(spark, sf_dir):
    return ngramjoin.similarity_classes(_table(spark, sf_dir, "documents"))


def op11_interval_expansion(spark, sf_dir):
    found = byterepeats.byte_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    return periodic.periodic_run_digests(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_prefix_targets, op2_line_field, op3_site_spread, op4_best_fit, op5_toxicity_chain, op6_repeated_spans,
        op7_personal_data, op8_posting_lists, op9_source_mix, op10_ngram_join, op11_interval_expansion, op12_collocations,
         op13_periodic_runs,
    )
}

_ESCAPED = "replace(replace(replace({0}, chr(92), chr(92) || 'b'), '#', chr(92) || 'h'), '<', chr(92) || 'l')"
ORACLES = {
    "op1_prefix_targets": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, chr(92) || '### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length({_ESCAPED.format('text')}) + length(replace({_ESCAPED.format('role')}, ':', chr(92) || 'c'))) AS BIGINT)
         AS formatted_chars,
       count(*) FILTER (WHERE role = 'assistant') AS n_examples
FROM turns GROUP BY conv_id
""",
    "op3_site_spread": linededup.ORACLE,
    "op12_collocations": collocations.ORACLE,
    # A class joins by sharing a shingle; components of the links by a recursive walk.
}
