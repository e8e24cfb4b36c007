"""Alignment of two tokenizers by divide and conquer at shared cuts.

A text's two token sequences cover the same bytes.  A token end that both share is a cut.  An interval
of both sequences is divided at the cut nearest its middle, found by bisecting the other side's ends,
and both halves likewise; an interval without a cut inside is a leaf: one group of tokens.  All open
intervals of a block of documents are divided together, level by level.  Tokens of a group are linked,
all with all.

How many documents hold an id pair is counted over the corpus: a block of about BLOCK_BYTES of text
first reduces its documents to distinct pairs, so that a pair that every document holds is one row per
block.  Counts return to the blocks the same way, where the documents' links, kept as places in their
block's list of pairs, are looked up.

Rows: every row is a document, repeated rows and null ids included.  Texts that are null, empty, or
not given back byte for byte by both tokenizers have no tokens: zeros and an empty string.  Further
columns are ignored.
"""
from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldops.llm import common as C
from fieldops.llm.packing import Encoder

#: bytes of text whose documents share one list of pairs
BLOCK_BYTES = 1 << 22
#: links of a group beyond which its ids are reduced to distinct ones before they are paired
WIDE = 4096
#: pairs made at a time
SLICE = 1 << 22
COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


# ---------------------------------------------------------------- tokens

class Tokens:
    """Ids of both tokenizers for a text, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings are plain text
        self.a.special = []
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocab = self.a.tokenizer.get_vocab()
        stands = byte_letters()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(stands[c] for c in token) if all(c in stands for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A of space+text and by B of text; none where the bytes are not those of space+text."""
        none = np.zeros(0, np.uint32)
        of_a, of_b = [none] * len(texts), [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        for i, b in zip(full, self.b.encode([texts[i] for i in full], num_threads=1)):
            a, whole = self.a.encode(" " + texts[i]), (" " + texts[i]).encode()
            if b"".join([self.bytes_a[x] for x in a.tolist()]) == whole and b"".join([self.bytes_b[x] for x in b]) == whole:
                of_a[i], of_b[i] = a, np.array(b, np.uint32)
        return of_a, of_b


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes for themselves, the
    others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


# ---------------------------------------------------------------- divide and conquer

def _cut_near_middle(ends_a, ends_b, lo, hi):
    """For intervals of A tokens [lo, hi): the token nearest the middle whose end, inside the interval,
    is also an end of B, or -1.  Probes go outwards from the middle in doubling rings."""
    found = np.full(len(lo), -1, np.int64)
    middle = (lo + hi - 2) // 2  # inside ends are those of tokens lo .. hi - 2
    open_, inner, outer = np.arange(len(lo)), 0, 1
    while len(open_):
        m, first, last = middle[open_], lo[open_], hi[open_] - 2
        best = np.full(len(open_), -1, np.int64)
        for sign in (1, -1):
            start = np.maximum(first, m - outer + 1) if sign < 0 else m + inner
            stop = m - inner if sign < 0 else np.minimum(last, m + outer - 1)
            if sign < 0 and not inner:
                stop = stop - 1
            size = np.maximum(stop - start + 1, 0)
            probe = C.ranges(start, size)
            owner = np.repeat(np.arange(len(open_)), size)
            at = np.searchsorted(ends_b, ends_a[probe])
            hit = ends_b[at] == ends_a[probe]
            probe, owner = probe[hit], owner[hit]
            near = np.full(len(open_), -1, np.int64)
            if sign > 0:
                near[owner[::-1]] = probe[::-1]  # the first of each owner
            else:
                near[owner] = probe  # the last
            nearer = (near >= 0) & ((best < 0) | (np.abs(near - m) < np.abs(best - m)))
            best[nearer] = near[nearer]
        found[open_] = best
        left = (best < 0) & ((m - outer >= first) | (m + outer <= last))
        open_, inner, outer = open_[left], outer, outer * 2
    return found


def leaves(ends_a: np.ndarray, ends_b: np.ndarray, edges_a: np.ndarray, edges_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token places after which groups end, in A and in B, for documents laid end to end.

    ends: byte offsets of token ends; edges: places in them where documents start, and the end."""
    lo_a, hi_a, lo_b, hi_b = edges_a[:-1], edges_a[1:], edges_b[:-1], edges_b[1:]
    some = hi_a > lo_a
    open_ = [x[some] for x in (lo_a, hi_a, lo_b, hi_b)]
    done_a, done_b = [], []
    while len(open_[0]):
        lo_a, hi_a, lo_b, hi_b = open_
        cut = np.full(len(lo_a), -1, np.int64)
        wide = np.flatnonzero((hi_a - lo_a > 1) & (hi_b - lo_b > 1))
        cut[wide] = _cut_near_middle(ends_a, ends_b, lo_a[wide], hi_a[wide])
        leaf = cut < 0
        done_a.append(hi_a[leaf])
        done_b.append(hi_b[leaf])
        lo_a, hi_a, lo_b, hi_b, cut = (x[~leaf] for x in (lo_a, hi_a, lo_b, hi_b, cut))
        other = np.searchsorted(ends_b, ends_a[cut]) + 1
        # halves stay in order, so that probes go through the ends once, upwards
        open_ = [np.stack(x, 1).ravel() for x in ((lo_a, cut + 1), (cut + 1, hi_a), (lo_b, other), (other, hi_b))]
    none = np.zeros(0, np.int64)
    return np.sort(np.concatenate([none, *done_a])), np.sort(np.concatenate([none, *done_b]))


# ---------------------------------------------------------------- links

def _links(a, b, start_a, size_a, start_b, size_b, doc):
    """Slices of (document, A id, B id, how often) of the links of all groups."""
    n = size_a * size_b
    narrow = np.flatnonzero(n <= WIDE)
    total = np.concatenate(([0], np.cumsum(n[narrow])))
    at = 0
    while at < len(narrow):
        to = max(at + 1, int(np.searchsorted(total, total[at] + SLICE, side="right")) - 1)
        g = narrow[at:to]
        each_a = np.repeat(C.ranges(start_a[g], size_a[g]), np.repeat(size_b[g], size_a[g]))
        each_b = C.ranges(np.repeat(start_b[g], size_a[g]), np.repeat(size_b[g], size_a[g]))
        yield np.repeat(doc[g], n[g]), a[each_a].astype(np.int64), b[each_b].astype(np.int64), np.ones(len(each_a), np.int64)
        at = to
    for g in np.flatnonzero(n > WIDE).tolist():
        ids_a, many_a = np.unique(a[start_a[g]: start_a[g] + size_a[g]], return_counts=True)
        ids_b, many_b = np.unique(b[start_b[g]: start_b[g] + size_b[g]], return_counts=True)
        step = max(1, SLICE // len(ids_b))
        for i in range(0, len(ids_a), step):
            part, many = ids_a[i: i + step].astype(np.int64), many_a[i: i + step]
            yield (np.full(len(part) * len(ids_b), doc[g]), np.repeat(part, len(ids_b)), np.tile(ids_b.astype(np.int64), len(part)),
                   np.outer(many, many_b).ravel())


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


def _lines(a, b, group_end_a, group_end_b, digits_a, digits_b):
    """Text `a1,a2|b1;a3|...` of all groups end to end, and the place after each token's separator."""
    n_a, n_b = len(a), len(b)
    size_a = np.diff(np.concatenate(([0], group_end_a)))
    size_b = np.diff(np.concatenate(([0], group_end_b)))
    place_a = np.arange(n_a) + np.repeat(group_end_b - size_b, size_a)
    place_b = np.arange(n_b) + np.repeat(group_end_a, size_b)
    rows = np.zeros((n_a + n_b, digits_a[0].shape[1] + 1), np.uint8)
    length = np.zeros(n_a + n_b, np.int64)
    mark = np.full(n_a + n_b, ord(","), np.uint8)
    mark[place_a[group_end_a - 1]] = ord("|")
    mark[place_b[group_end_b - 1]] = ord(";")
    for place, ids, (digits, sizes) in ((place_a, a, digits_a), (place_b, b, digits_b)):
        rows[place, :-1] = digits[ids]
        length[place] = sizes[ids]
    rows[np.arange(len(rows)), length] = mark
    length += 1
    flat = rows[np.arange(rows.shape[1]) < length[:, None]]
    return flat, np.cumsum(length)


def digit_table(n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n - 1, left-aligned, and their numbers."""
    text = np.array([str(i) for i in range(n)], f"S{width}")
    return text.view(np.uint8).reshape(n, width), np.char.str_len(text).astype(np.int64)


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.tokens = Tokens(path_a, path_b)
        n_a, n_b = len(self.tokens.bytes_a), len(self.tokens.bytes_b)
        width = len(str(max(n_a, n_b)))
        self.digits = digit_table(n_a, width), digit_table(n_b, width)
        self.n_b = n_b

    def block(self, texts: list[str | None]) -> tuple[dict, list[bytes], list[bytes], np.ndarray, np.ndarray]:
        """Counts by document; its links as places in the block's pairs, and how often; these pairs, and
        how many documents hold each."""
        of_a, of_b = self.tokens.encode(texts)
        edges_a = np.concatenate(([0], np.cumsum([len(x) for x in of_a]))).astype(np.int64)
        edges_b = np.concatenate(([0], np.cumsum([len(x) for x in of_b]))).astype(np.int64)
        a, b = np.concatenate(of_a) if of_a else np.zeros(0, int), np.concatenate(of_b) if of_b else np.zeros(0, int)
        ends_a, ends_b = np.cumsum(self.tokens.len_a[a]), np.cumsum(self.tokens.len_b[b])
        stop_a, stop_b = leaves(ends_a, ends_b, edges_a, edges_b)
        size_a, size_b = np.diff(np.concatenate(([0], stop_a))), np.diff(np.concatenate(([0], stop_b)))
        group_edges = np.searchsorted(stop_a, edges_a, side="right")
        doc = np.searchsorted(edges_a, stop_a - size_a, side="right") - 1

        keys, often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = len(self.tokens.bytes_a) * self.n_b
        for d, ids_a, ids_b, many in _links(a, b, stop_a - size_a, size_a, stop_b - size_b, size_b, doc):
            k, w = _summed(d * own + ids_a * self.n_b + ids_b, many)
            keys, often = (k, w) if not len(keys) else _summed(np.concatenate((keys, k)), np.concatenate((often, w)))
        in_doc = keys // own
        pairs, place, holders = np.unique(keys - in_doc * own, return_inverse=True, return_counts=True)
        at = np.searchsorted(in_doc, np.arange(len(texts) + 1))
        raw, often = place.astype("<u4"), often.astype("<u4" if not len(often) or often.max() < 1 << 32 else "<u8")

        sums = np.concatenate(([0], np.cumsum(size_a * size_b)))
        line, after = _lines(a, b, stop_a, stop_b, *self.digits)
        line, cuts = line.tobytes(), np.concatenate(([0], after))
        shas = []
        for i in range(len(texts)):
            s, e = cuts[edges_a[i] + edges_b[i]], cuts[edges_a[i + 1] + edges_b[i + 1]]
            shas.append(hashlib.sha256(line[s:e - 1]).hexdigest() if e > s else "")
        counts = {"n_a": np.diff(edges_a), "n_b": np.diff(edges_b), "n_groups": np.diff(group_edges),
                  "n_links": sums[group_edges[1:]] - sums[group_edges[:-1]], "groups_sha256": shas}
        return (counts, [raw[at[i]:at[i + 1]].tobytes() for i in range(len(texts))],
                [often[at[i]:at[i + 1]].tobytes() for i in range(len(texts))], pairs, holders)


# ---------------------------------------------------------------- over the corpus

def align(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    schema = f"block string, doc_id long, {COUNTS}, places binary, often binary, pairs array<long>, holders array<int>"

    def run(batches):
        import uuid

        aligner = None
        for b in C.steps(batches, max_bytes=block_bytes):
            aligner = aligner or Aligner(path_a, path_b)
            counts, places, often, pairs, holders = aligner.block(b.column(1).to_pylist())
            m, name = b.num_rows, uuid.uuid4().hex
            # the block's pairs go with a row of their own
            more = [pa.array([*v, None], pa.string() if k == "groups_sha256" else pa.int64()) for k, v in counts.items()]
            lists = [pa.array([*[None] * m, list_], pa.list_(kind)) for list_, kind in ((pairs, pa.int64()), (holders, pa.int32()))]
            ids = pa.concat_arrays([b.column(0).cast(pa.int64()), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (m + 1)), ids, *more, pa.array([*places, None], pa.binary()),
                 pa.array([*often, None], pa.binary()), *lists],
                names=["block", "doc_id", *counts, "places", "often", "pairs", "holders"])

    done = C.staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "aligned")
    own = done.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "p")).select(
        "block", "place", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    counts = ranked(own.groupBy("pair").agg(F.sum("holders").alias("n")), path_b)
    back = own.select("block", "place", "pair").join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    left = done.where("pairs is null").select("block", "doc_id", *[c.split()[0] for c in COUNTS.split(", ")], "places", "often")
    out = T.StructType([f for f in left.schema.fields if f.name not in ("block", "places", "often")]).add("n_best", "long").add(
        "count_sum", "long")

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        n = np.zeros(found.num_rows, np.int64)
        best = np.zeros(found.num_rows, bool)
        place = found.column("place").to_numpy()
        n[place] = found.column("n").to_numpy()
        best[place] = found.column("best").to_numpy()
        n_best, total = [], []
        for places, often in zip(rows.column("places").to_pylist(), rows.column("often").to_pylist()):
            at = np.frombuffer(places, "<u4")
            w = np.frombuffer(often, "<u8" if len(often) > len(places) else "<u4").astype(np.int64)
            n_best.append(int(w[best[at]].sum()))
            total.append(int((w * n[at]).sum()))
        kept = rows.drop_columns(["block", "places", "often"])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    return left.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(look_up, out)


def ranked(counts: DataFrame, path_b: str) -> DataFrame:
    """counts (pair, n) with ``best``: no pair of the same A id has a higher count.

    An A id has at most as many pairs as B has ids, so its rows need no splitting."""
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = C.staged(counts, "pairs")
    with_a = counts.withColumn("a", F.expr(f"pair div {n_b}"))
    most = with_a.groupBy("a").agg(F.max("n").alias("most"))
    return with_a.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
