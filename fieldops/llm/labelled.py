"""A bounded, balanced sample of labelled documents, and models fitted to it in one executor task."""
from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: labelled documents of each class that a classifier is fitted to, at most
PER_CLASS = 1000


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, float]:
    """(text, label, order) of up to per_class documents of each class, and the share of label 1
    among all labelled ids.

    Ids are drawn by hash, so reruns agree.  An id with several labels counts as 0 if any is 0;
    null ids and null labels are not used.  Only the ids (2 x per_class at most) are broadcast."""
    rows = (labels.where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("label"))
            .withColumn("order", F.xxhash64("doc_id")))
    count = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))
    drawn = [rows.where(F.col("label") == k).orderBy("order", "doc_id").limit(per_class) for k in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id").select(
        "text", "label", "order"), share


def fit(drawn: DataFrame, learn: Callable[[list[str], list[int]], bytes]) -> bytes:
    """learn(texts, labels) in one task over the bounded sample, in an order that reruns share."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("text", "ascending")])
        model = learn(table.column("text").to_pylist(), table.column("label").to_pylist())
        return pa.table({"model": pa.array([model], pa.binary())})

    got = drawn.groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda t: run(t.select(["text", "label", "order"])), "model binary").collect()
    return got[0]["model"] if got else learn([], [])
