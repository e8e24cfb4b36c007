"""Quality rules: fixed limits and a hashed n-gram logistic regression.

The limits need counts of words, symbols, repeated lines and repeated three-word windows.  The
regression sees three families of features, each as shares of the document: hashed words, hashed
word pairs and hashed four-byte strings.  It is fitted to three quarters of a bounded balanced
sample (``labelled.PER_CLASS`` documents of each class, chosen by hash); the rest calibrates its
sums to probabilities (a slope and an intercept, at the true share of the classes).  Everything is
computed from whole texts, in Arrow batches, and held against fixed thresholds.

Rows: a null or empty text has no words and fails the limits.  Without labels of both classes the
probability is the share of label 1 (0.5 if there are none).  Repeated rows are judged alike.
Further columns are passed on; of a name that is also a result's, the result stays.
"""
from __future__ import annotations

import io

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldops.llm import common as C
from fieldops.llm import labelled

MIN_WORDS = 50
#: base_failed if more than so many of a hundred words lie in repeated windows
MAX_REPEAT_PERCENT = 50
#: kept only if the calibrated probability of label 1 is at least this
MIN_PROBABILITY = 0.5
BITS = 16
FAMILIES = 3
ROUNDS, RATE, DECAY = 120, 0.3, 1e-6
SCALE = 30.0
#: bytes from which lines are compared by a digest
LONG_LINE = 512
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_doc(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each range of offsets."""
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offs])


def _repeated_words(hashes: np.ndarray, woffs: np.ndarray) -> np.ndarray:
    """Words of each document that lie in a three-word window found twice or more in it."""
    docs = len(woffs) - 1
    doc = np.repeat(np.arange(docs), np.diff(woffs))
    if len(hashes) < 3:
        return np.zeros(docs, np.int64)
    inside = np.flatnonzero(doc[2:] == doc[:-2])
    key = C.mix(hashes[inside] + C.mix(hashes[inside + 1] + C.mix(hashes[inside + 2] + doc[inside].astype(np.uint64))))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = inside[order[twice]]
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[at + k] = True
    return _per_doc(covered, woffs)


def _repeated_lines(buf: np.ndarray, offs: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the document."""
    docs = len(offs) - 1
    breaks = np.flatnonzero(buf == 10)
    start = np.sort(np.concatenate((offs[:-1], breaks + 1)))
    # a break at a document's very end opens an empty line there, which sorts before the next one
    doc = np.searchsorted(offs, start, side="right") - 1
    doc = np.minimum(doc, docs - 1)
    end = np.minimum(np.append(start[1:] - 1, len(buf)), len(buf))
    closed = np.concatenate(([0], buf == 10))[offs[doc + 1]]  # a break at the document's very end
    end = np.where(np.append(doc[1:] != doc[:-1], True), offs[doc + 1] - closed, end)
    end = np.maximum(end, start)
    solid = np.concatenate(([0], np.cumsum(~C._SPACE[buf])))
    real = solid[end] > solid[start]
    start, end, doc = start[real], end[real], doc[real]
    hashes = C.range_hash(prefix, start, end)
    # there are different sequences of 1,024 bytes and more whose polynomial sums agree: long lines take a digest
    for i in np.flatnonzero(end - start >= LONG_LINE).tolist():
        hashes[i] = int.from_bytes(blake2b(buf[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    key = C.mix(hashes + C.mix(doc.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=docs) - np.bincount(doc[first], minlength=docs)


def _analyse(buf: np.ndarray, offs: np.ndarray) -> tuple[dict, list]:
    """Counts of each document, and the hashed features: (index array, offsets) by family."""
    prefix = C.prefix_hash(C.BYTE_VALUES[buf])
    starts, ends, woffs = C.word_spans(buf, offs)
    words = C.range_hash(prefix, starts, ends)
    letters = (buf & 0xC0) != 0x80
    counts = {"n_words": np.diff(woffs), "word_chars": _per_doc(letters & ~C._SPACE[buf], offs),
              "n_symbols": _per_doc(_SYMBOL[buf], offs), "n_dup_lines": _repeated_lines(buf, offs, prefix),
              "n_repeat_words": _repeated_words(words, woffs)}
    shift = np.uint64(64 - BITS)
    one = (words >> shift).astype(np.int32)
    two = (C.mix(words[:-1] + C.mix(words[1:])) >> shift).astype(np.int32) if len(words) else one
    two = np.append(two, 0)[: len(one)]
    b = buf.astype(np.uint32)
    four = np.zeros(len(buf), np.int32)
    if len(b) > 3:
        four[:-3] = (((b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24) * np.uint32(2654435761)) >> np.uint32(32 - BITS))
    # the last pair of a document and its last three bytes look across its end: they get weight 0
    pair_ok = np.ones(len(two), bool)
    pair_ok[(woffs[1:] - 1)[np.diff(woffs) > 0]] = False
    byte_ok = np.ones(len(buf), bool)
    for k in (1, 2, 3):
        last = offs[1:] - k
        byte_ok[last[last >= offs[:-1]]] = False
    return counts, [(one, woffs, None), (two, woffs, pair_ok), (four, offs, byte_ok)]


def _sums(weights: np.ndarray, families: list) -> np.ndarray:
    """Each document's sum of its families' mean weights."""
    out = 0.0
    for k, (index, offs, ok) in enumerate(families):
        w = weights[k][index]
        if ok is not None:
            w = np.where(ok, w, 0.0)
        total = np.diff(np.concatenate(([0.0], np.cumsum(w, dtype=np.float64)))[offs])
        out = out + SCALE * total / np.maximum(np.diff(offs), 1)
    return out


def train(texts: list[str], labels: list[int], share: float) -> bytes:
    """Weights and calibration; share is the true share of label 1."""
    model = {"weights": np.zeros((FAMILIES, 1 << BITS)), "line": np.zeros(2)}
    share = min(max(share if labels else 0.5, 1e-3), 1 - 1e-3)
    if len(set(labels)) < 2:
        model["line"][1] = np.log(share / (1 - share))
        return _dump(model)
    y = np.array(labels, np.float64)
    fit = np.arange(len(y)) % 4 != 3
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit[:] = True
    cells = []  # distinct (document, feature) pairs with their shares, by family
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, families = _analyse(raw, np.array([0, len(raw)]))
        for k, (index, offs, ok) in enumerate(families):
            found, n = np.unique(index if ok is None else index[ok], return_counts=True)
            cells.append((np.full(len(found), i, np.int32), found.astype(np.int64) + (k << BITS),
                          (SCALE * n / max(1, offs[-1])).astype(np.float32)))
    doc, feature, value = (np.concatenate(x) for x in zip(*cells))
    used, feature = np.unique(feature, return_inverse=True)
    weight = np.where(y == 1, 0.5 / max(1, (y[fit] == 1).sum()), 0.5 / max(1, (y[fit] == 0).sum())) * fit
    w, bias, energy = np.zeros(len(used)), 0.0, np.full(len(used), 1e-8)
    bias_energy = 1e-8
    for _ in range(ROUNDS):  # gradient descent with a step of its own for each weight
        z = np.bincount(doc, w[feature] * value, len(y)) + bias
        gap = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(feature, gap[doc] * value, len(used)) + DECAY * w
        energy += g * g
        bias_energy += gap.sum() ** 2
        w -= RATE * g / np.sqrt(energy)
        bias -= RATE * gap.sum() / np.sqrt(bias_energy)
    flat = model["weights"].ravel()
    flat[used] = w
    z = np.bincount(doc, w[feature] * value, len(y))
    rest = ~fit if not fit.all() else fit
    model["line"][:] = _calibrate(z[rest], y[rest], share)
    return _dump(model)


def _calibrate(z: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and intercept that make probabilities of sums, by Newton steps on weighted likelihood."""
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x = np.stack([z, np.ones_like(z)], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * line
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        line = line - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def _dump(model: dict) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, weights=model["weights"].astype(np.float32), line=model["line"])
    return out.getvalue()


def learn(docs: DataFrame, labels: DataFrame, per_class: int = labelled.PER_CLASS) -> bytes:
    """A model of docs (doc_id, text) and labels (doc_id, quality)."""
    drawn, share = labelled.sample(docs, labels, per_class)
    return labelled.fit(drawn, lambda texts, marks: train(texts, marks, share))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: bytes) -> DataFrame:
    """docs (doc_id, text, ...) with the five counts, base_failed, probability and kept."""
    held = C.carry(docs, "doc_id", "text")
    schema = C.extended(held.schema, *[(c, "long") for c in COUNTS], ("base_failed", "boolean"),
                        ("probability", "double"), ("kept", "boolean"))

    def run(batches):
        with np.load(io.BytesIO(model)) as f:
            weights, line = f["weights"], f["line"]
        for b in C.steps(batches):
            counts, families = _analyse(*C.text_buffer(b.column(1)))
            p = 1 / (1 + np.exp(-np.clip(line[0] * _sums(weights, families) + line[1], -30, 30)))
            failed = (counts["n_words"] < MIN_WORDS) | (
                100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(counts[c].astype(np.int64)) for c in COUNTS], pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= MIN_PROBABILITY))], names=schema.names)

    return C.restore(held.mapInArrow(run, schema), "doc_id", "text", *COUNTS, "base_failed", "probability", "kept")
