"""Repeated windows of a fixed length, found through sampled anchors.

A window of ``window`` elements (bytes or words) is represented by the smallest ``gram`` inside it
(leftmost on ties).  Equal windows pick the same gram at the same place, so two equal windows
always meet under that gram's hash, yet only about one position in half a window is kept.  An
*anchor* is such a position with the run of window starts that it stands for:

    (h: hash of the gram, c: hash of all that its windows cover, did, tk, s0, s1)

Anchors with the same (h, c) agree on every window; only anchors that share h and differ in c
need their windows compared one by one, and of equal ones a single representative does.
Words' windows are compared by 64-bit fingerprints, bytes' in suffix order (``suffix_scan.py``).

For doubling, an anchor also carries the gram at twice its length: a window that starts at ``cut`` or
later holds the gram and as much behind it (hash ``hr``), one that starts earlier the gram and as
much before it (``hl``).  Equal windows are on the same side, so the doubled gram is inside them too.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C
from fieldops.llm import suffix_scan

_POS_BITS = 24
#: bytes of text that are scanned at once
SCAN_BYTES = 1 << 18
#: elements that are scanned at once; a longer document is scanned in overlapping pieces
_PIECE = 1 << 18
ANCHOR_SCHEMA = "h long, c long, did long, tk long, s0 int, s1 int"
DOUBLED_SCHEMA = ANCHOR_SCHEMA + ", cut int, hr long, hl long"


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for each i, by running minima inside blocks of w."""
    n = len(x)
    pad = np.full(-n % w + w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate((x, pad)).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1: n])


def _gram_keys(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What grams are chosen by: their hash, then their place (the low bits)."""
    return (grams >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | at.astype(np.uint64)


def _scan(values: np.ndarray, offs: np.ndarray, gram: int, window: int):
    """Anchors of all documents in a run of values: (document, s0, s1, h, c, p, prefix sums), s0, s1 and
    the gram's place p in the run."""
    none = np.zeros(0, np.int64)
    if len(values) < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, np.zeros(1, np.uint64)
    prefix = C.prefix_hash(values)
    at = np.arange(len(values) - gram + 1)
    grams = C.range_hash(prefix, at, at + gram)
    least = _sliding_min(_gram_keys(grams, at), window - gram + 1)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(least)]
    good = np.flatnonzero(np.arange(len(least)) + window <= offs[doc + 1])
    if not len(good):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none, prefix
    pos = (least[good] & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], pos[1:] != pos[:-1])))
    last = np.concatenate((first[1:], [len(pos)])) - 1
    s0, s1, p = good[first], good[last], pos[first]
    cover = C.range_hash(prefix, s0, s1 + window)
    cover = C.mix(cover + (p - s0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                  + (p - s1).astype(np.uint64))
    return doc[s0], s0, s1, grams[p], cover, p, prefix


def _twice(p: np.ndarray, prefix: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams at p with as much behind and before them; where that leaves the run no window
    holds it, and the hash is not used."""
    right = C.range_hash(prefix, p, np.minimum(p + 2 * gram, len(prefix) - 1))
    left = C.range_hash(prefix, np.maximum(p - gram, 0), p + gram)
    return right, C.mix(left + np.uint64(1))  # never met under one key


def _elements(buf: np.ndarray, offs: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    if unit == "byte":
        return C.BYTE_VALUES[buf], offs
    starts, ends, woffs = C.word_spans(buf, offs)
    return C.word_hashes(buf, starts, ends), woffs


def anchors(docs: DataFrame, unit: str, gram: int, window: int, doubled: bool = False) -> DataFrame:
    """Anchors of docs (did, tk, text); unit is "byte" or "word".  doubled: with cut, hr and hl, which
    needs 2 * gram <= window and 3 * gram <= window + 1."""
    schema = DOUBLED_SCHEMA if doubled else ANCHOR_SCHEMA

    def run(batches):
        for b in C.steps(batches, max_bytes=SCAN_BYTES):
            values, offs = _elements(*C.text_buffer(b.column(b.schema.get_field_index("text"))), unit)
            did = b.column(b.schema.get_field_index("did")).to_numpy(zero_copy_only=False)
            tk = b.column(b.schema.get_field_index("tk")).to_numpy(zero_copy_only=False)
            pieces = [(0, len(values), offs)]
            if len(values) > _PIECE:  # one document or a few: scan each in overlapping pieces
                pieces = [(a, min(a + _PIECE + window - 1, e), None) for s, e in zip(offs[:-1], offs[1:])
                          for a in range(s, max(s + 1, e - window + 1), _PIECE)]
            for lo, hi, own in pieces:
                doc, s0, s1, h, c, p, prefix = _scan(values[lo:hi], own if own is not None else np.array([0, hi - lo]),
                                                     gram, window)
                if own is None:
                    doc = np.full(len(s0), np.searchsorted(offs, lo, side="right") - 1)
                shift = lo - offs[doc]
                cols = [C.signed(h), C.signed(c), pa.array(did[doc]), pa.array(tk[doc]),
                        pa.array((s0 + shift).astype(np.int32)), pa.array((s1 + shift).astype(np.int32))]
                if doubled:
                    cut = (p + 2 * gram - window + shift).astype(np.int32)
                    cols += [pa.array(cut), *[C.signed(x) for x in _twice(p, prefix, gram)]]
                yield pa.RecordBatch.from_arrays(cols, names=["h", "c", "did", "tk", "s0", "s1", "cut", "hr", "hl"][:len(cols)])

    return docs.select("did", "tk", "text").mapInArrow(run, schema)


#: classes of one gram that are compared in one task
GROUP = 4096
#: bytes of contexts that are compared at once
COMPARE_BYTES = 1 << 20


def _contexts(docs: DataFrame, reps: DataFrame, unit: str, window: int) -> DataFrame:
    """What the windows of each run of reps (h, salts, did, tk, s0, s1) hold: the bytes they cover, or
    for words the windows' hashes."""
    runs = reps.groupBy("did", "tk").agg(F.collect_list(F.struct("h", "salts", "s0", "s1")).alias("runs"))
    texts = C.squeezed(docs.select("did", "tk", "text")).join(runs, ["did", "tk"])

    def run(batches):
        for b in C.steps(batches, "z", C.SMALL_STEP):
            buf, offs = C.joined(C.expanded(b))
            lists = b.column(b.schema.get_field_index("runs"))
            doc = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            h, salts, s0, s1 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            did = b.column(b.schema.get_field_index("did")).to_numpy(zero_copy_only=False)[doc]
            tk = b.column(b.schema.get_field_index("tk")).to_numpy(zero_copy_only=False)[doc]
            if unit == "byte":
                a = (offs[doc] + s0).tolist()
                e = (offs[doc] + s1 + window).tolist()
                data = buf.tobytes()
                held = [data[x:y] for x, y in zip(a, e)]
            else:
                values, woffs = _elements(buf, offs, unit)
                n = (s1 - s0 + 1).astype(np.int64)
                at = C.ranges(woffs[doc] + s0, n)
                data = C.range_hash(C.prefix_hash(values), at, at + window).tobytes()
                cut = (8 * np.concatenate(([0], np.cumsum(n)))).tolist()
                held = [data[x:y] for x, y in zip(cut[:-1], cut[1:])]
            salt = C.mix(did.astype(np.uint64) + C.mix(tk.astype(np.uint64) + s0.astype(np.uint64))) % salts.astype(np.uint64)
            for i in range(0, len(held), 5000):
                p = slice(i, i + 5000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[p]), pa.array(salt[p].astype(np.int32)), pa.array(salts[p] > 1), pa.array(did[p]),
                     pa.array(tk[p]), pa.array(s0[p].astype(np.int32)), pa.array(held[p], pa.binary())],
                    names=["h", "salt", "hot", "did", "tk", "s0", "held"])

    return texts.mapInArrow(run, "h long, salt int, hot boolean, did long, tk long, s0 int, held binary")


FOUND_SCHEMA = "w long, did long, tk long, s0 int, s1 int"


def _compare(rows: pa.Table, window: int, keep_first: bool) -> pa.RecordBatch:
    """Runs of repeated windows among whole groups of words' contexts (w null), and of groups that are
    dealt over several tasks the first spot of each distinct window (w its hash)."""
    did, tk, s0 = (rows.column(c).to_numpy() for c in ("did", "tk", "s0"))
    hot = rows.column("hot").to_numpy()
    buf, offs = C.text_buffer(rows.column("held"))
    n = np.diff(offs) // 8
    w = np.frombuffer(buf.tobytes(), np.uint64)
    own = np.repeat(np.arange(len(n)), n)
    s = C.ranges(s0.astype(np.int64), n)
    order = np.lexsort((s, tk[own], did[own], w))
    w, own, s = w[order], own[order], s[order]
    new = np.ones(len(w), bool)
    new[1:] = w[1:] != w[:-1]
    same_spot = np.zeros(len(w), bool)  # rows that repeat a document give its spots again
    same_spot[1:] = ~new[1:] & (s[1:] == s[:-1]) & (did[own[1:]] == did[own[:-1]]) & (tk[own[1:]] == tk[own[:-1]])
    w, own, s, new = w[~same_spot], own[~same_spot], s[~same_spot], new[~same_spot]
    flagged = ~new
    if not keep_first:
        flagged[:-1] |= ~new[1:]
    one = np.flatnonzero(new & hot[own])
    return _found(did, tk, own[flagged], s[flagged], own[one], s[one], w[one])


def _scan_contexts(rows: pa.Table, gram: int, window: int) -> pa.RecordBatch:
    """The same of bytes' contexts, by suffix order; every window that repeats is in a run, first or not."""
    h, did, tk, s0 = (rows.column(c).to_numpy() for c in ("h", "did", "tk", "s0"))
    order = np.lexsort((s0, tk, did, h))
    again = np.zeros(len(order), bool)  # rows that repeat a document
    again[1:] = True
    for x in (h, did, tk, s0):
        again[1:] &= x[order[1:]] == x[order[:-1]]
    rows = rows.take(order[~again])
    h, did, tk, s0 = (rows.column(c).to_numpy() for c in ("h", "did", "tk", "s0"))
    hot = rows.column("hot").to_numpy()
    buf, offs = C.text_buffer(rows.column("held"))
    group = np.cumsum(np.concatenate(([0], h[1:] != h[:-1])))
    place = suffix_scan.places(buf, offs, gram, window, _gram_keys)
    own, at, one, one_at = suffix_scan.repeated(buf, offs, group, place, window, hot)
    first = offs[one] + one_at
    w = C.range_hash(C.prefix_hash(C.BYTE_VALUES[buf]), first, first + window)
    return _found(did, tk, own, s0[own] + at, one, s0[one] + one_at, w)


def _found(did, tk, f_own, f_s, one, one_s, w) -> pa.RecordBatch:
    """Starts f_s of contexts f_own made runs, and single starts one_s of contexts one with their hash."""
    order = np.lexsort((f_s, f_own))
    f_own, f_s = f_own[order], f_s[order]
    start = np.ones(len(f_s), bool)
    start[1:] = (f_own[1:] != f_own[:-1]) | (f_s[1:] != f_s[:-1] + 1)
    a = np.flatnonzero(start)
    b = np.append(a[1:], len(f_s)) - 1
    row = np.concatenate((f_own[a], one)) if len(a) else one
    lo, hi = np.concatenate((f_s[a], one_s)), np.concatenate((f_s[b] if len(a) else f_s, one_s))
    mark = pa.array(np.concatenate((np.zeros(len(a), np.int64), w.view(np.int64))),
                    mask=np.arange(len(row)) < len(a))
    return pa.RecordBatch.from_arrays(
        [mark, pa.array(did[row]), pa.array(tk[row]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
        names=["w", "did", "tk", "s0", "s1"])


def repeated_starts(docs: DataFrame, reps: DataFrame, unit: str, window: int, keep_first: bool, gram: int = 0) -> DataFrame:
    """Window by window, the starts (did, tk, s0, s1) inside the runs of reps that repeat among them.

    reps: (h, k, did, tk, s0, s1), k the number of rows with this h.  Windows can only be equal
    under the same h, so contexts are sorted by h and compared in one task, up to GROUP; more of one
    h are dealt over several tasks, each of which sends on its distinct windows once, and those are
    compared by aggregate and join.
    keep_first (words only): only those for which the same sequence also starts earlier (smaller did,
    tk, start); else all for which it starts anywhere else.  gram: its length, for bytes."""
    salted = reps.withColumn("salts", F.ceil(F.col("k") / GROUP).cast("int"))
    rows = _contexts(docs, salted, unit, window)
    rows = rows.repartition(C.partitions(docs.sparkSession), "h", "salt").sortWithinPartitions("h", "salt")

    def compare(held: pa.Table) -> pa.RecordBatch:
        return _scan_contexts(held, gram, window) if unit == "byte" else _compare(held, window, keep_first)

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size < COMPARE_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            h, salt = rows.column("h").to_numpy(), rows.column("salt").to_numpy()
            last = np.flatnonzero((h != h[-1]) | (salt != salt[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
            if cut:
                yield compare(rows.slice(0, cut))
            held, size = rows.slice(cut).to_batches(), rows.slice(cut).nbytes
        if held:
            yield compare(pa.Table.from_batches(held))

    found = C.staged(rows.mapInArrow(run, FOUND_SCHEMA), "found")
    sure = found.where("w is null").drop("w")
    open_ = found.where("w is not null")
    spot = F.struct("did", "tk", "s0")
    twice = C.staged(open_.groupBy("w").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
                     .where("first != last").select("w", "first"), "twice")
    part = open_.join(twice, "w")
    if keep_first:
        part = part.where(spot > F.col("first"))
    return sure.unionByName(part.select("did", "tk", "s0", "s1"))


def with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """docs (did, tk, text, ...), the text compressed, with the arrays s0s and s1s of its runs (null
    where it has none)."""
    spans = runs.groupBy("did", "tk").agg(F.collect_list("s0").alias("s0s"), F.collect_list("s1").alias("s1s"))
    return C.squeezed(docs).join(spans, ["did", "tk"], "left")


def removal_mask(n: int, s0, s1, window: int) -> np.ndarray:
    """Which of n elements a window that starts in one of the runs covers."""
    s0, s1 = np.asarray(s0, np.int64), np.asarray(s1, np.int64)
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, s0, 1)
    np.add.at(delta, s1 + window, -1)
    return np.cumsum(delta[:n]) > 0
