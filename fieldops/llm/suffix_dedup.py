"""Suffix-array de-duplication with a logarithmic index family.

The corpus arrives in batches.  Each batch gets a suffix array, which is merge-scanned against the
levels that exist and then becomes a level itself; levels of equal size are merged, so n batches
leave at most log2(n) + 1 levels and each suffix is rewritten at most log2(n) times.

The array is sparse.  A full one (8 bytes or more per byte of text) does not fit the disk that a
corpus of 100 TB leaves, and is not needed: every string of ``min_bytes`` bytes is found through
the anchor that represents it (``repeats.py``), so suffixes that start at anchors suffice.  They
are ordered by the 64-bit fingerprint of their first ``min_bytes // 4`` bytes, which brings those
that share this prefix together; what follows the prefix is put into suffix order for those that repeat,
and long matches are read from the common lengths of neighbours (``suffix_scan.py``).  An entry stands
for all anchors with the same surroundings: a passage copied a million times is one entry, made
by a partial aggregate before anything is shuffled.  Levels are bucketed and sorted by the
fingerprint, so scans join them without a shuffle.

Rows: a null or empty text has no match and gives (0, 0, 0, hash of nothing).  Rows with the same
doc_id and text are one document (neither is "elsewhere" for the other); rows that share only the
id are different documents.  A null doc_id is an id like any other.  Further columns are passed on; of a name that is also a result's, the
result stays.
"""
from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.llm import common as C
from fieldops.llm import repeats as R

MIN_BYTES = 400
BATCHES = 4


#: entries that a task reduces before it sends them on
REDUCE_ROWS = 500_000


class SuffixIndex:
    """Levels of sorted suffix entries (h, c, a0, a1): prefix fingerprint, fingerprint of the
    surroundings, smallest anchor id, and largest if the entry has more than one anchor."""

    def __init__(self, spark: SparkSession, min_bytes: int = MIN_BYTES):
        self.spark, self.min_bytes = spark, min_bytes
        self.buckets = C.partitions(spark)
        self.name = f"suffix_{uuid.uuid4().hex[:12]}"
        self.levels: list[tuple[int, str]] = []  # (batches it holds, table), largest first
        self.made = 0
        self.found: DataFrame | None = None
        self.anchors: DataFrame | None = None

    def _write(self, entries: DataFrame) -> str:
        """A level of entries (h, c, a0, a1): dealt by h, equal entries made one, sorted."""
        self.made += 1
        table = f"{self.name}_{self.made}"
        last = F.max(F.coalesce("a1", "a0"))
        dealt = _reduced(entries).repartition(self.buckets, "h").groupBy("h", "c").agg(
            F.min("a0").alias("a0"), last.alias("last"))
        dealt = dealt.select("h", "c", "a0", F.when(F.col("last") != F.col("a0"), F.col("last")).alias("a1"))
        (dealt.sortWithinPartitions("h").write.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(table))
        return table

    def _merge_equal(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels[-2:]
            self.levels[-2:] = [(2 * size, self._write(self.spark.table(a).unionByName(self.spark.table(b))))]
            self._drop(a, b)

    def _drop(self, *tables: str) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def add(self, docs: DataFrame) -> None:
        """Index a batch (did, tk, text) and note all entries, old and new, whose prefix repeats."""
        anchors = C.staged(R.anchors(docs, "byte", self.min_bytes // 4, self.min_bytes), "anchors")
        self.anchors = anchors if self.anchors is None else self.anchors.unionByName(anchors)
        self._merge_equal()  # of earlier batches, put off until another one comes
        none = F.lit(None).cast("long").alias("a1")
        table = self._write(anchors.select("h", "c", _anchor_id().alias("a0"), none))
        new = self.spark.table(table)
        own = new.groupBy("h").agg(((F.count("*") > 1) | (F.count("a1") > 0)).alias("twice"))
        olds = [self.spark.table(t) for _, t in self.levels]
        for i, old in enumerate(olds):
            own = own.join(old.groupBy("h").agg(F.lit(True).alias(f"old{i}")), "h", "left")
        is_old = F.lit(False)
        for i in range(len(olds)):
            is_old = is_old | F.coalesce(F.col(f"old{i}"), F.lit(False))
        shared = own.where(F.col("twice") | is_old).select("h")
        found = new.join(shared, "h", "left_semi")
        for old in olds:
            found = found.unionByName(old.join(new, "h", "left_semi"))
        found = C.staged(found, "found")
        self.found = found if self.found is None else self.found.unionByName(found)
        self.levels.append((1, table))

    def repeated(self, docs: DataFrame) -> DataFrame:
        """Runs (did, tk, s0, s1) of starts of strings of min_bytes that start elsewhere too."""
        entries = self.found.groupBy("h", "c").agg(F.min("a0").alias("a0"), F.max(F.coalesce("a1", "a0")).alias("a1"))
        entries = C.staged(entries, "entries")
        # written before they are joined: else a hot prefix's rows would be kept in one task
        count = C.staged(entries.groupBy("h").agg(F.count("*").alias("k")), "prefixes")
        wanted = C.staged(entries.join(count, "h").where("a0 != a1 or k > 1"), "wanted")
        marks = C.staged(self.anchors.join(wanted, ["h", "c"]), "marks")
        whole = marks.where("a0 != a1").select("did", "tk", "s0", "s1")
        reps = marks.where((F.col("k") > 1) & (_anchor_id() == F.col("a0"))).select("h", "k", "did", "tk", "s0", "s1")
        return whole.unionByName(R.repeated_starts(docs, reps, "byte", self.min_bytes, False, self.min_bytes // 4))

    def drop(self) -> None:
        self._drop(*[t for _, t in self.levels])
        self.levels = []


def _anchor_id():
    return F.xxhash64("did", "tk", "s0")


def _reduced(entries: DataFrame) -> DataFrame:
    """Entries (h, c, a0, a1) with those of one task that are equal made one, before they are sent."""

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= REDUCE_ROWS:
                yield reduce(held)
                held, size = [], 0
        if held:
            yield reduce(held)

    def reduce(held):
        t = pa.Table.from_batches(held)
        h, c, a0 = (t.column(x).to_numpy() for x in ("h", "c", "a0"))
        a1 = np.where(t.column("a1").is_null().to_numpy(), a0, t.column("a1").fill_null(0).to_numpy())
        order = np.lexsort((c, h))
        h, c, a0, a1 = h[order], c[order], a0[order], a1[order]
        first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))))
        low, high = np.minimum.reduceat(a0, first), np.maximum.reduceat(a1, first)
        return pa.RecordBatch.from_arrays(
            [pa.array(h[first]), pa.array(c[first]), pa.array(low), pa.array(high, mask=low == high)], names=["h", "c", "a0", "a1"])

    return entries.select("h", "c", "a0", "a1").mapInArrow(run, "h long, c long, a0 long, a1 long")


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, batches: int = BATCHES,
                   kept: str | None = "binary") -> DataFrame:
    """docs (doc_id, text, ...) with n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the
    text without every byte covered by a repeated string of min_bytes bytes.

    A cut may fall inside a character: ``kept`` is "binary", or "string" without the pieces of
    divided characters, or None, and then the column is left out."""
    spark = docs.sparkSession
    keyed = C.with_key(C.carry(docs, "doc_id", "text"))
    index = SuffixIndex(spark, min_bytes)
    for j in range(batches):
        part = keyed.where(F.pmod(F.hash("did", "tk"), F.lit(batches)) == j)
        index.add(part.select("did", "tk", "text"))
    runs = C.staged(index.repeated(keyed), "runs")
    index.drop()
    cut = _cut(R.with_runs(keyed, runs), min_bytes, kept)
    return C.restore(cut, "doc_id", *["text"] * bool(kept), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * bool(kept))


def _cut(df: DataFrame, min_bytes: int, as_kind: str | None) -> DataFrame:
    rest = [c for c in df.columns if c not in ("z", "s0s", "s1s", "did", "tk")]
    schema = C.extended(
        df.select(*rest).schema, ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"),
        ("kept_sha256", "string"), *[("text", "string"), ("kept", as_kind)] * bool(as_kind))

    def run(batches):
        for b in C.steps(batches, "z", C.SMALL_STEP):
            texts = C.expanded(b)
            s0s = b.column(b.schema.get_field_index("s0s")).to_pylist()
            s1s = b.column(b.schema.get_field_index("s1s")).to_pylist()
            removed, spans, kept = [], [], []
            for text, s0, s1 in zip(texts, s0s, s1s):
                gone = R.removal_mask(len(text), s0, s1, min_bytes) if s0 else np.zeros(1, bool)
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[0]))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if s0 else text)
            extra = [pa.array([len(x) for x in texts], pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            if as_kind:
                extra.append(pa.array([x.decode() for x in texts], pa.string()))
                extra.append(pa.array(kept, pa.binary()) if as_kind == "binary" else
                             pa.array([x.decode(errors="ignore") for x in kept], pa.string()))
            own = [b.column(b.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays(own + extra, names=schema.names)

    return df.mapInArrow(run, schema)
