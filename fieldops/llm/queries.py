"""The registered queries of this subpackage: each applies its operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.llm import (alignment, hash_forest, html_mincut, kneser_ney, mixing, online_packing, packing, quality_cnn,
                          quality_rules, simhash_golay, substring_dedup, suffix_dedup, whitening)
from fieldops.llm.common import table

#: vocabulary file of the packing queries, by name in the public tokenizers' package
TOKENIZER = "byte_bpe_50k.json"
#: the second tokenizer of the alignment query
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_cnn.learn(docs, table(spark, sf_dir, "labels"))
    return quality_cnn.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op3_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hash_forest.search(vectors, vectors.where("vec_id % 50 = 0"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept", "probability")


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_golay.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, kept=None).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_documents(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, kept=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECE_TOKENIZER))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mixing, op2_quality_cnn, op3_hash_forest, op4_quality_rules, op5_simhash_golay, op6_suffix_dedup,
        op7_html_mincut, op8_packing, op9_kneser_ney, op10_substring_dedup, op11_online_packing, op12_whitening,
        op13_alignment)}


# ---------------------------------------------------------------- SQL for those that SQL can express

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))) AS d
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS room,
         ([5.0, 2.0, 1.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM per),
levels AS (
  SELECT *, row_number() OVER o AS place,
         ((SELECT sum(source_size) FROM per) * 1.5::DOUBLE
          - coalesce(sum(room) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY room / weight, source NULLS LAST)),
chosen AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= room),
targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN c.level IS NULL THEN l.room ELSE least(l.room, c.level * l.weight) END AS target
  FROM levels l, chosen c),
goals AS (
  SELECT *, (goal // source_size) * ceil(source_size / 1024)::BIGINT + ceil(goal % source_size / 1024)::BIGINT AS need
  FROM (SELECT *, round(target)::BIGINT AS goal FROM targets WHERE target >= 0.5)),
shares AS (
  SELECT *, (sum(goal) OVER o)::BIGINT / (sum(goal) OVER ())::BIGINT AS hi,
         coalesce((sum(goal) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT / (sum(goal) OVER ())::BIGINT, 0) AS lo
  FROM goals WINDOW o AS (ORDER BY source NULLS LAST)),
points AS (
  SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS x
  FROM (SELECT unnest(range((SELECT sum(need)::BIGINT FROM goals))) AS slot)),
drawn AS (
  SELECT s.source, p.slot, row_number() OVER (PARTITION BY s.source ORDER BY p.slot) - 1 AS place
  FROM points p JOIN shares s ON p.x >= s.lo AND p.x < s.hi),
placed AS (
  SELECT docs.doc_id, docs.source, docs.size, t.source_size, t.target, round(t.target)::BIGINT AS goal,
         (sum(docs.size) OVER (PARTITION BY docs.source ORDER BY d, docs.size ROWS UNBOUNDED PRECEDING) - docs.size)::BIGINT AS start
  FROM docs JOIN targets t ON docs.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(start + size, goal) - start, 0)
        + greatest(least(start + size, goal - source_size) - start, 0))::BIGINT AS taken,
       CASE WHEN size > 0 AND start < goal AND target >= 0.5
            THEN coalesce(d.slot, (SELECT sum(need)::BIGINT FROM goals) + p.start // 1024) END::BIGINT AS first_slot
FROM placed p LEFT JOIN drawn d ON p.source IS NOT DISTINCT FROM d.source AND p.start // 1024 = d.place
"""

OP10_SQL = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
windows AS (
  SELECT doc_id, i, word, count(*) OVER f AS n, string_agg(word, ' ') OVER f AS seq
  FROM words WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (
  SELECT doc_id, i, word,
         n = 20 AND row_number() OVER (PARTITION BY n, seq ORDER BY doc_id, i) > 1 AS later
  FROM windows),
marked AS (
  SELECT doc_id, i, word,
         bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM firsts),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS line
  FROM marked GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(line, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1_SQL, "op10_substring_dedup": OP10_SQL}
