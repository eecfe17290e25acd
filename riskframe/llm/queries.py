"""Queries over the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import conversation_trie, hard_negatives, language_id, line_dedup, mixing, packing, pieces, quality_rules, secrets, simhash, suffix_dedup, token_counts, topk
from riskframe.llm.common import read
from riskframe.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(read(spark, folder, "labels"))
    return quality_rules.quality_report(read(spark, folder, "documents"), trusted)


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup(read(spark, folder, "documents"))
    return kept.select(F.col("row.doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (
  SELECT k, max(doc_id) AS newest FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, i, line, often.k IS NOT NULL AND doc_id <> newest AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.component_ids(read(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read(spark, folder, "documents"))


@query
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode(read(spark, folder, "documents"))
    back = pieces.decode(coded, "pieces", "decoded")
    ids = F.col("pieces").cast("string")
    return back.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(ids, 256).alias("pieces_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


@query
def op1_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(read(spark, folder, "embeddings"))


ORACLES["op1_topk_search"] = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
parts AS (SELECT vec_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    # A cache of its own for each call, which an earlier run over the English documents has left; the
    # run over the whole table then finds their counts and adds those of all other texts.
    docs, cache = read(spark, folder, "documents"), scratch_path(spark, "token-cache")
    token_counts.token_counts(docs.where("lang = 'en'"), cache)
    return token_counts.token_counts(docs, cache)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(read(spark, folder, "documents"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, folder, "documents"))
    line = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"),
        F.size(F.filter("spans", lambda x: x["kind"] == "random")).cast("long").alias("n_random"),
    )


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.dedup(read(spark, folder, "documents"))
    return cut.select(F.col("row.doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents")).drop("ids")


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(read(spark, folder, "conversations"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    return hard_negatives.mine(rows.withColumn("label", hard_negatives.moved_label()))


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
parts AS (SELECT vec_id, label, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, any_value(a.label) = any_value(c.label) AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM parts a JOIN parts c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY 1, 2),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
near AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM near WHERE rank <= 10
"""
