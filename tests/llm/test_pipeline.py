"""The pipeline's stages against brute force, and the queries against their SQL."""
import os
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import corpus_pipeline as P
from fieldops.llm import mixing, quality_cnn, queries, simhash_golay, suffix_dedup

from test_operators import brute_bytes, brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    names = docs.columns
    assert [f for _, f in P.STAGES] == [P.keep_quality, P.drop_near_duplicates, P.remove_passages, P.mix_sources, P.pack_sequences]
    kept = P.keep_quality(spark, docs, SF)
    assert kept.columns == names and 0 < kept.count() < docs.count()
    one = P.drop_near_duplicates(spark, docs, SF)
    groups = {c for _, _, c in brute_components(docs.collect())}
    assert one.columns == names and sorted(str(r.doc_id) for r in one.collect()) == sorted(groups)
    cut = P.remove_passages(spark, docs, SF)
    sizes = {i: n - g for (i, _), (n, g, _, _) in brute_bytes(docs.collect(), P.PASSAGE_BYTES).items()}
    for r in cut.collect():
        assert 0 <= sizes[r.doc_id] - len(r.text.encode()) <= 40 and r.n_chars == len(r.text)
    mixed = P.mix_sources(spark, docs, SF)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert mixed.columns == names and got == {k: v for k, v in taken.items() if v}
    out = P.run(spark, SF)
    full = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert full <= 1024


def test_stages_on_odd_rows(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for df in (plain, none):
        for name, stage in P.STAGES:
            out = stage(spark, df, str(tmp_path))
            if stage is not P.pack_sequences:
                assert out.columns == df.columns
            assert out.count() >= 0
    once = P.drop_near_duplicates(spark, plain, str(tmp_path))
    groups = simhash_golay.near_duplicates(plain).select(F.coalesce(F.col("component_id").cast("string"), F.hex("fp"))).distinct().count()
    assert once.count() == groups


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert (a.values == b.values).all()


def test_sql_of_the_mix_with_nulls(spark):
    """As test_sql, for rows of which the mix takes nothing: their first_slot is NULL on both sides."""
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op1_mixing"]).df().astype(object)
    cols = list(want.columns)
    want = {tuple(None if x != x or x is None else x for x in r) for r in want.where(want.notna(), None)[cols].values.tolist()}
    got = {tuple(r) for r in queries.queries()["op1_mixing"](spark, SF).select(*cols).collect()}
    assert got == want and any(None in r for r in got)


def test_stages_hand_texts_over_in_small_batches(spark):
    """Of rows of 10 KB each, a batch that a worker gets holds 4 MB or so."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    wide = spark.range(2000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a word "), 1500).alias("text"))
    P.pack_sequences(spark, wide.limit(1), SF)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    assert wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 5 << 20
    spark.conf.set(key, "1m")  # a caller's own limit stays
    P.pack_sequences(spark, wide.limit(1), SF)
    assert spark.conf.get(key) == "1m"
    spark.conf.unset(key)


def test_a_step_of_the_classifier_takes_little_memory():
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 4000), pa.array(["some words of a text " * 50] * 4000)], names=["doc_id", "text"])

    class Frame:  # stands for the documents: keeps what score() runs
        schema = StructType().add("doc_id", "long").add("text", "string")

        def mapInArrow(self, run, schema):
            self.run = run
            raise StopIteration

    frame, net = Frame(), quality_cnn.train([], [], 0.5)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(quality_cnn.C, "carry", lambda docs, *names: docs)
        with pytest.raises(StopIteration):
            quality_cnn.score(frame, net)
    tracemalloc.start()
    assert sum(b.num_rows for b in frame.run(iter([rows]))) == 4000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
