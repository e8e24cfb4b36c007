"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays.

Three passes of Spark jobs build the model in the shared folder; none gathers it in one place.

1. Words: tasks count the word hashes of their documents and send them, cut by hash range, to the
   tasks that own the ranges, which write sorted arrays.  A word's place in them is its number.
2. Bigrams: the same with pairs of word numbers, cut by the pair's hash; each owner writes its
   range's sorted hashes and counts, and passes on partial sums by context and by second word.
3. Those sums become arrays by word number: tokens, and distinct successors seen once, twice or
   more often of each context; distinct predecessors of each word.

Scoring tasks map the arrays into memory and search them for what their documents hold, so workers
of one machine share the pages and no worker loads the model.  Tokens are counted before anything
is sent, so a frequent word costs a row per task at most.

The shared folder must be one that processes can open (a mounted path); else an error says so.

Rows: a null or empty text has the end token alone.  All rows count, also repeated ones; a null id
counts as the empty text when rows are held out.  Further columns are ignored.
"""
from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C

#: pairs or words that a task collects before it counts and sends them
FLUSH = 3_000_000
END = C.mix(np.array([0xE0D], np.uint64))[0]
START_ID = (1 << 32) - 1
_NONE = np.zeros(0, np.uint64)


def shared_path(spark, name: str) -> str:
    """A new folder in the shared folder as a path that open() takes."""
    url = urlparse(C.shared_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError("the language model needs spark.checkpoint.dir on a mounted path to map files from")
    path = os.path.join(url.path, f"llm-{name}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


# ---------------------------------------------------------------- counted arrays, sent and stored

def _count(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    if not len(keys):
        return keys, np.zeros((0, *(() if counts is None else counts.shape[1:])), np.int64)
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first, axis=0)


def _blob(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences and counts, bytes of equal weight together, compressed.

    Before these their number and the bytes of a count: 4, or 8 where one needs more."""
    size = 8 if counts.size and counts.max() >= 1 << 32 else 4
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    parts = [steps.view(np.uint8).reshape(-1, 8).T.tobytes(),
             counts.astype(f"<u{size}").reshape(len(keys), -1).view(np.uint8).reshape(len(keys), -1).T.tobytes()]
    return np.int64(len(keys)).tobytes() + bytes([size]) + pa.compress(b"".join(parts), codec="lz4_raw", asbytes=True)


def _unblob(blob: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    size = blob[8]
    raw = np.frombuffer(pa.decompress(blob[9:], decompressed_size=n * (8 + size * width), codec="lz4_raw", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(raw[8 * n:].reshape(size * width, n).T).view(f"<u{size}")
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64).reshape((n, width) if width > 1 else n)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Hash range of each hash: the 64-bit space in equal parts."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _rows(shard: list[int], blob: list[bytes], kind: list[int] | None = None) -> pa.RecordBatch:
    cols = [pa.array(shard, pa.int32()), pa.array(blob, pa.binary())]
    names = ["shard", "blob"]
    if kind is not None:
        cols, names = [pa.array(kind, pa.int32()), *cols], ["kind", *names]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _send(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, order: np.ndarray | None = None):
    """(shard, blob) of each shard's keys, in key order."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(shard) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = order[a:b]
        yield int(shard[a]), _blob(keys[own], counts[own])


def _save(path: str, name: str, array: np.ndarray) -> None:
    """Written under another name first: a task that runs twice leaves one whole file."""
    temp = os.path.join(path, f".{name}-{uuid.uuid4().hex}")
    with open(temp, "wb") as f:
        np.save(f, array)
    os.replace(temp, os.path.join(path, name + ".npy"))


def _open(path: str, name: str) -> np.ndarray:
    """The array, mapped, or read if it is empty (which cannot be mapped)."""
    file = os.path.join(path, name + ".npy")
    if not os.path.exists(file):
        return np.zeros(0, np.uint64)
    try:
        return np.load(file, mmap_mode="r")
    except ValueError:
        return np.load(file)


class _Sharded:
    """Sorted hash arrays in files by hash range, opened when first searched."""

    def __init__(self, path: str, name: str, shards: int):
        self.path, self.name, self.shards = path, name, shards
        self.files: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, place in it or -1, count) of sorted hashes."""
        shard = _shard(hashes, self.shards).astype(np.int64)
        place, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            if s not in self.files:
                self.files[s] = (_open(self.path, f"{self.name}-{s}"), _open(self.path, f"{self.name}-count-{s}"))
            keys, counts = self.files[s]
            if not len(keys):
                continue
            part = slice(cuts[s], cuts[s + 1])
            at = np.minimum(np.searchsorted(keys, hashes[part]), len(keys) - 1)
            hit = keys[at] == hashes[part]
            place[part] = np.where(hit, at, -1)
            count[part] = np.where(hit, counts[at], 0)
        return shard, place, count


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's tokens, the end token last, and the documents' offsets."""
    buf, offs = C.text_buffer(batch.column(batch.schema.get_field_index("text")))
    starts, ends, words = C.word_spans(buf, offs)
    n = len(offs) - 1
    out = np.empty(len(starts) + n, np.uint64)
    last = words[1:] + np.arange(n)
    spot = np.ones(len(out), bool)
    spot[last] = False
    out[spot] = C.word_hashes(buf, starts, ends, lower=True)
    out[last] = END
    return out, np.concatenate(([0], last + 1))


# ---------------------------------------------------------------- the model

class KneserNey:
    """A trained model: its folder and the few numbers that scoring needs."""

    def __init__(self, path: str, shards: int, offsets: np.ndarray, total: int):
        self.path, self.shards, self.offsets, self.total = path, shards, offsets, total
        self.vocabulary = int(offsets[-1])
        self.discount2 = self.discount1 = np.zeros(4)
        self.types = 0
        self.rest1 = 1.0

    # ---- passes

    @classmethod
    def train(cls, docs: DataFrame, shards: int | None = None) -> KneserNey:
        """Model of docs (text)."""
        spark = docs.sparkSession
        shards = shards or C.partitions(spark)
        path = shared_path(spark, "ngram")
        docs = docs.select(F.coalesce("text", F.lit("")).alias("text"))

        def words(batches):
            held, size = [], 0
            for b in C.steps(batches):
                held.append(_tokens(b)[0])
                size += len(held[-1])
                if size >= FLUSH:
                    yield _rows(*zip(*_send(*(x := _count(np.concatenate(held))), _shard(x[0], shards))))
                    held, size = [], 0
            if held:
                yield _rows(*zip(*_send(*(x := _count(np.concatenate(held))), _shard(x[0], shards))))

        def own_words(table: pa.Table) -> pa.Table:
            parts = [_unblob(x.as_py(), 1) for x in table.column("blob")]
            keys, counts = _count(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            s = table.column("shard")[0].as_py()
            _save(path, f"word-{s}", keys)
            _save(path, f"word-count-{s}", counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64))
            return pa.table({"shard": pa.array([s], pa.int32()), "n": pa.array([len(keys)], pa.int64()),
                             "total": pa.array([int(counts.sum())], pa.int64())})

        sizes = (docs.mapInArrow(words, "shard int, blob binary").groupBy("shard")
                 .applyInArrow(own_words, "shard int, n long, total long").collect())  # a row per range
        n = np.zeros(shards, np.int64)
        for r in sizes:
            n[r["shard"]] = r["n"]
        if n.sum() >= START_ID:  # a pair of numbers is one 64-bit key
            raise ValueError("more than 2^32 - 2 distinct tokens")
        model = cls(path, shards, np.concatenate(([0], np.cumsum(n))), sum(r["total"] for r in sizes))
        model._count_pairs(docs)
        return model

    def _ids(self, hashes: np.ndarray, words: _Sharded) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) of each hash."""
        distinct, back = np.unique(hashes, return_inverse=True)
        shard, place, count = words.find(distinct)
        number = np.where(place >= 0, self.offsets[shard] + place, -1)
        return number[back], count[back]

    @staticmethod
    def _contexts(ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The token before each token; the start of the text before the first."""
        before = np.empty(len(ids), np.int64)
        before[1:] = ids[:-1]
        before[offs[:-1]] = START_ID
        return before

    def _count_pairs(self, docs: DataFrame) -> None:
        model, shards, path = self, self.shards, self.path
        span = max(1, -(-(self.vocabulary + 1) // shards))  # word numbers by range; the start is the last

        def pairs(batches):
            words = _Sharded(path, "word", shards)
            held, size = [], 0

            def flush():
                keys, counts = _count(np.concatenate(held))
                return _rows(*zip(*_send(keys, counts, _shard(C.mix(keys), shards))))

            for b in C.steps(batches):
                tokens, offs = _tokens(b)
                ids, _ = model._ids(tokens, words)
                before = model._contexts(ids, offs)
                held.append((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
                size += len(ids)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
            if held:
                yield flush()

        def own_pairs(table: pa.Table) -> pa.Table:
            parts = [_unblob(x.as_py(), 1) for x in table.column("blob")]
            keys, counts = _count(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            s = table.column("shard")[0].as_py()
            hashes = C.mix(keys)
            order = np.argsort(hashes)
            _save(path, f"pair-{s}", hashes[order])
            _save(path, f"pair-count-{s}", counts[order].astype(np.uint32 if counts.max() < 1 << 32 else np.uint64))
            context = keys >> np.uint64(32)
            context = np.where(context == START_ID, np.uint64(model.vocabulary), context)
            marks = np.stack([counts, counts == 1, counts == 2, counts > 2], axis=1).astype(np.int64)
            shard, blob, kind = [], [], []
            for k, (ids, sums) in enumerate((_count(context, marks), _count(keys & np.uint64(START_ID)))):
                for to, x in _send(ids, sums, ids // np.uint64(span)):
                    kind.append(k)
                    shard.append(to)
                    blob.append(x)
            kind.append(2)  # how many pairs are seen once, twice, three and four times
            shard.append(0)
            blob.append(np.array([(counts == i).sum() for i in range(1, 5)], np.int64).tobytes())
            return pa.Table.from_batches([_rows(shard, blob, kind)])

        sums = C.staged(docs.mapInArrow(pairs, "shard int, blob binary").groupBy("shard")
                        .applyInArrow(own_pairs, "kind int, shard int, blob binary"), "sums")

        def own_sums(table: pa.Table) -> pa.Table:
            s = table.column("shard")[0].as_py()
            kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
            first = s * span
            n = min(span, model.vocabulary + 1 - first)
            context = np.zeros((n, 4), np.int64)
            before = np.zeros(n, np.int64)
            for kind, blob in zip(kinds, blobs):
                ids, counts = _unblob(blob, 4 if kind == 0 else 1)
                into = context if kind == 0 else before
                into[ids.astype(np.int64) - first] += counts  # ids are distinct within a blob
            _save(path, f"context-{s}", context)
            _save(path, f"before-{s}", before)
            of = [int((before == i).sum()) for i in range(1, 5)] + [int((before > 0).sum()), int(before.sum())]
            return pa.table({"shard": pa.array([s], pa.int32()), "of": pa.array([of], pa.list_(pa.int64()))})

        pair_counts = np.zeros(4, np.int64)
        for r in sums.where("kind = 2").select("blob").collect():  # four numbers a range
            pair_counts += np.frombuffer(r["blob"], np.int64)
        word_counts = np.zeros(6, np.int64)
        for r in sums.where("kind < 2").groupBy("shard").applyInArrow(own_sums, "shard int, of array<long>").collect():
            word_counts += np.array(r["of"], np.int64)
        self.span = span
        self.discount2 = _discounts(pair_counts)
        self.discount1 = _discounts(word_counts[:4])
        self.types = int(word_counts[5])
        if self.types:
            more = word_counts[4] - word_counts[0] - word_counts[1]
            self.rest1 = float(np.dot(self.discount1[1:], [word_counts[0], word_counts[1], more]) / self.types)

    # ---- probabilities

    def score(self, docs: DataFrame) -> DataFrame:
        """docs (text, ...) with n_tokens, n_known, base_score and score (log10)."""
        model = self
        schema = C.extended(docs.schema, ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"),
                            ("score", "double"))

        def run(batches):
            words = _Sharded(model.path, "word", model.shards)
            bigrams = _Sharded(model.path, "pair", model.shards)
            by_id = _ById(model)
            for b in C.steps(batches):
                tokens, offs = _tokens(b)
                ids, counts = model._ids(tokens, words)
                base = np.log10((counts + 1) / (model.total + model.vocabulary + 1))
                logp = np.log10(model.probability(ids, model._contexts(ids, offs), bigrams, by_id))
                at = offs[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.diff(offs)), pa.array(np.add.reduceat((counts > 0).astype(np.int64), at)),
                     pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(logp, at))], names=schema.names)

        return docs.mapInArrow(run, schema)

    def probability(self, ids: np.ndarray, before: np.ndarray, bigrams: _Sharded, by_id: _ById) -> np.ndarray:
        """p(token | token before); -1 is an unknown token, all of which share one place."""
        if not self.types:
            return np.full(len(ids), 1 / (self.vocabulary + 1))
        known = ids >= 0
        lower = np.full(len(ids), self.rest1 / (self.vocabulary + 1))
        cont = by_id.take("before", ids[known])
        lower[known] += (cont - self.discount1[np.minimum(cont, 3)]) / self.types
        context = np.where(before == START_ID, self.vocabulary, before)
        seen = context >= 0
        stats = np.zeros((len(ids), 4), np.int64)
        stats[seen] = by_id.take("context", context[seen])
        seen = stats[:, 0] > 0
        total = np.maximum(stats[:, 0], 1)
        rest = np.where(seen, stats[:, 1:] @ self.discount2[1:] / total, 1.0)
        both = known & seen
        keys = (before[both].astype(np.uint64) << np.uint64(32)) | ids[both].astype(np.uint64)
        distinct, back = np.unique(C.mix(keys), return_inverse=True)
        count = bigrams.find(distinct)[2][back]
        own = np.zeros(len(ids))
        own[both] = (count - self.discount2[np.minimum(count, 3)]) / total[both]
        return own + rest * lower


class _ById:
    """Arrays by word number in files by range, opened when first read."""

    def __init__(self, model: KneserNey):
        self.path, self.span = model.path, model.span
        self.files: dict[str, np.ndarray] = {}

    def take(self, name: str, ids: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(ids, return_inverse=True)
        shard = distinct // self.span
        out = np.zeros((len(distinct), 4) if name == "context" else len(distinct), np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(shard) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            file = f"{name}-{shard[a]}"
            if file not in self.files:
                self.files[file] = _open(self.path, file)
            out[a:b] = self.files[file][distinct[a:b] - shard[a] * self.span]
        return out[back]


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more, from the numbers of items seen
    1, 2, 3 and 4 times; kept within a tenth of their bounds where those numbers are too few."""
    y = n[0] / max(n[0] + 2 * n[1], 1)
    d = [k - (k + 1) * y * n[k] / max(n[k - 1], 1) for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.1), k - 0.1) for k, x in zip((1, 2, 3), d))])


def held_out(doc_id: Column) -> Column:
    return C.crc_remainder(doc_id, 7) == 2


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, text),
    learnt from those that are not held out."""
    model = KneserNey.train(docs.where(~held_out(F.col("doc_id"))))
    flagged = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = model.score(flagged).withColumn("train_tokens", F.lit(model.total).cast("long"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
