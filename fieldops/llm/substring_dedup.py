"""Substring de-duplication by level-wise doubling.

Level by level, only windows that repeat at one length are extended to twice that length: 5 words,
10, 20.  The first level counts five-word grams, sampled so that each window holds the gram that
stands for it (``repeats.py``).  Places whose gram repeats and whose surroundings (all that the
gram's windows cover) are alike are copies: their windows repeat as a whole, and one place stands for
all from then on.  Of places whose surroundings differ, the grams of twice the length are counted,
and only where these repeat are the windows themselves compared, four times as long as the first.
No level looks at text that did not repeat at the level before.  ``longer_repeats`` goes on with
longer windows until no candidate survives.

Rows: a null, empty or short text has no window; it keeps all its words.  "Earlier" is the order of
(doc_id, text hash, start) with a null doc_id first, so rows that share only the id are ordered by
their texts, and rows with the same doc_id and text are one document: none is earlier than the
other, and all get the same result.  Further columns are passed on; of a name
that is also a result's, the result stays.
"""
from __future__ import annotations

import hashlib
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C
from fieldops.llm import repeats as R

WINDOW = 20


def later_runs(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Runs (did, tk, s0, s1) of starts of windows of keyed (did, tk, text) whose word sequence also
    starts earlier."""
    gram = max(1, window // 4)
    doubled = 2 * gram <= window
    level1 = R.anchors(keyed, "word", gram, window, doubled)
    # written first: a side that is still to be aggregated would keep a hot gram's rows in one task
    again = C.staged(level1.select("h").groupBy("h").count().where("count > 1").select("h"), "grams")
    hits = C.staged(level1.join(again, "h", "left_semi"), "hits")
    here = F.struct("did", "tk", "s0", "s1")
    place = F.struct("did", "tk", "s0", "s1", *["cut", "hr", "hl"] * doubled)
    classes = C.staged(hits.groupBy("h", "c").agg(F.min(place).alias("rep"), F.max(here).alias("last")), "classes")
    rep = F.struct(*[F.col(f"rep.{x}").alias(x) for x in ("did", "tk", "s0", "s1")])
    many = classes.where(rep != F.col("last")).select("h", "c", rep.alias("rep"))
    whole = hits.select("h", "c", "did", "tk", "s0", "s1").join(many, ["h", "c"]).where(here > F.col("rep"))
    split = C.staged(classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "split")
    reps = classes.join(split, "h").select("h", "k", "rep.*")
    if doubled:
        reps = _repeated_at_twice(reps)
    return whole.select("did", "tk", "s0", "s1").unionByName(R.repeated_starts(keyed, reps, "word", window, keep_first=True))


def _repeated_at_twice(reps: DataFrame) -> DataFrame:
    """Of places whose gram repeats, the runs (h, k, did, tk, s0, s1) whose gram of twice the length,
    h, repeats too, k times."""
    behind = F.when(F.col("s1") >= F.col("cut"), F.struct(F.col("hr").alias("h"), F.greatest("s0", "cut").alias("s0"), F.col("s1")))
    before = F.when(F.col("s0") < F.col("cut"), F.struct(F.col("hl").alias("h"), F.col("s0"), F.least(F.col("s1"), F.col("cut") - 1).alias("s1")))
    runs = reps.select("did", "tk", F.explode(F.array_compact(F.array(behind, before))).alias("run"))
    runs = C.staged(runs.select("run.h", "did", "tk", "run.s0", "run.s1"), "twice_as_long")
    again = C.staged(runs.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "longer_grams")
    return runs.join(again, "h").select("h", "k", "did", "tk", "s0", "s1")


def remove_repeats(docs: DataFrame, window: int = WINDOW, kept: bool = True) -> DataFrame:
    """docs (doc_id, text, ...) with n_words, n_removed, kept_sha256 and, if asked for, ``kept``, the
    words left, joined by one space (else the text is left out too)."""
    keyed = C.with_key(C.carry(docs, "doc_id", "text"))
    runs = C.staged(later_runs(keyed.select("did", "tk", "text"), window), "runs")
    df = R.with_runs(keyed, runs)
    rest = [c for c in df.columns if c not in ("z", "s0s", "s1s", "did", "tk")]
    with_text = kept
    schema = C.extended(df.select(*rest).schema, ("n_words", "long"), ("n_removed", "long"), ("kept_sha256", "string"),
                        *[("text", "string"), ("kept", "string")] * with_text)

    def run(batches):
        for b in C.steps(batches, "z", C.STEP_BYTES // 2):
            texts = C.expanded(b)
            s0s = b.column(b.schema.get_field_index("s0s")).to_pylist()
            s1s = b.column(b.schema.get_field_index("s1s")).to_pylist()
            n_words, removed, lines = [], [], []
            for text, s0, s1 in zip(texts, s0s, s1s):
                words = text.split()
                n_words.append(len(words))
                if s0:
                    words = list(compress(words, ~R.removal_mask(len(words), s0, s1, window)))
                removed.append(n_words[-1] - len(words))
                lines.append(b" ".join(words))
            extra = [pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in lines], pa.string())]
            if with_text:
                extra += [pa.array([x.decode() for x in y], pa.string()) for y in (texts, lines)]
            own = [b.column(b.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays(own + extra, names=schema.names)

    return C.restore(df.mapInArrow(run, schema), "doc_id", *["text"] * with_text, "n_words", "n_removed",
                     "kept_sha256", *["kept"] * with_text)


def longer_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(length, did, tk, s0, s1): the runs of starts of later occurrences of repeated windows of
    length window, 2 x window, 4 x window, ..., level by level until no candidate survives.

    Only documents that hold a repeat of one length are looked at for twice the length; the first
    occurrence of a longer window may lie in a document without a later one, so such documents
    stay if the gram of a survivor occurs in them."""
    keyed = C.with_key(docs.select("doc_id", "text")).select("did", "tk", "text")
    out, length = None, window
    while True:
        runs = C.staged(later_runs(keyed, length).select(F.lit(length).alias("length"), "did", "tk", "s0", "s1"), "level")
        out = runs if out is None else out.unionByName(runs)
        if runs.isEmpty():
            return out
        # a document can hold a longer repeat only if it holds one of this length, first or later
        grams = R.anchors(keyed, "word", max(1, length // 4), length)
        again = grams.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
        alive = C.staged(grams.join(again, "h", "left_semi").select("did", "tk").distinct(), "alive")
        keyed = C.staged(keyed.join(alive, ["did", "tk"], "left_semi"), "texts")
        length *= 2
