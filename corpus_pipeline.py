"""The corpus pipeline: documents to packed training sequences, in five stages.

quality classifier -> near duplicates -> repeated passages -> source mix -> packing.  Each stage
works on all that the one before kept.  All but the last return the columns of ``documents``.
An empty table passes through; null and repeated rows are treated as each operator states.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.llm import common, mixing, packing, quality_cnn, simhash_golay, suffix_dedup
from fieldops.llm.queries import tokenizer_path

#: repeated strings of so many bytes go from the texts: 50 words of five bytes with their blanks, so that
#: passages of over 50 words are found whatever their words' lengths
PASSAGE_BYTES = 250


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of these documents, gives label 1."""
    common.small_batches(spark)
    model = quality_cnn.learn(docs, common.table(spark, sf_dir, "labels"))
    scored = quality_cnn.score(docs, model)
    return scored.where("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (null last, then text hash)."""
    common.small_batches(spark)
    found = simhash_golay.near_duplicates(docs)
    # group: the component, or for null ids alone the fingerprint
    found = found.withColumn("grp", F.coalesce(F.col("component_id").cast("string"), F.hex("fp")))
    best = found.groupBy("grp").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tk"))).alias("best"), F.count("*").alias("n"))
    keep = best.select(F.col("best.doc_id").alias("_did"), F.col("best.tk").alias("_tk"))
    keyed = common.carry(docs, "doc_id", "text").withColumn("tk", F.xxhash64(F.coalesce("text", F.lit(""))))
    left = keyed.join(keep.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_did")) & (F.col("tk") == F.col("_tk")), "left_semi")
    # rows that repeat both id and text are one choice: only for those is the text grouped
    twice = common.staged(found.groupBy("doc_id", "tk").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("_did"), F.col("tk").alias("_tk")), "twice")
    if not twice.isEmpty():
        on = F.col("doc_id").eqNullSafe(F.col("_did")) & (F.col("tk") == F.col("_tk"))
        once = left.join(twice, on, "left_semi").groupBy("doc_id", "tk").agg(
            F.first("text").alias("text"), F.first(common.ROW).alias(common.ROW))
        left = left.join(twice, on, "left_anti").unionByName(once.select(left.columns))
    return common.restore(left, "doc_id", "text").select(*docs.columns)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of PASSAGE_BYTES bytes that start elsewhere too.

    A character that a cut divides goes with it.  A text that is all repeats stays as an empty one."""
    common.small_batches(spark)
    cut = suffix_dedup.remove_repeats(docs, PASSAGE_BYTES, kept="string")
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    return _with_text(cut.withColumn("text", text), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source cut where its share ends."""
    return _with_text(mixing.mixed_documents(docs), docs)


def _with_text(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, n_chars counted anew."""
    return df.select(*[F.char_length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
                       for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: learnt scores, hashes and tokenizers are beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
