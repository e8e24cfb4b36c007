"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are embedded, and each filter looks at eight of them at every fourth
place.  Chunks of 256 bytes that overlap by 64 cover the whole document; a filter's answer in a
chunk is its largest there.  The means of these over all chunks and their largest go through one
logistic unit, so a single chunk and the whole document both count.

It is fitted by gradient descent to a bounded balanced sample (``labelled.PER_CLASS`` documents of
each class), from the same chunks of the whole texts that scores come from; the intercept is then
moved to the true share of the classes.

Rows: a null or empty text is an empty document with a score like any other.  Without labels of
both classes the score is the share of label 1 (0.5 if there are no labels).  Repeated rows are
scored alike; a null id counts as the empty text when rows are held out.  Further columns are
passed on; of a name that is also a result's, the result stays.
"""
from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C
from fieldops.llm import labelled

KERNEL, STRIDE, DIM, FILTERS = 8, 4, 4, 16
#: a chunk is four units of 64 bytes and starts three units after the one before
UNIT, CHUNK_UNITS, STEP_UNITS = 64, 4, 3
PLACES = UNIT // STRIDE
EPOCHS, BATCH, RATE = 30, 64, 0.01
#: units whose answers are held at a time in training, so that a long text needs no more memory
SLICE = 4096
THRESHOLD = 0.7


def _layout(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(units of each document, its first unit): room for its bytes and eight zeros after them."""
    units = (np.diff(offs) + KERNEL + UNIT - 1) // UNIT
    return units, np.concatenate(([0], np.cumsum(units)))


def _padded(buf: np.ndarray, offs: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(first[-1] * UNIT + KERNEL, np.uint8)
    n = np.diff(offs)
    out[np.arange(len(buf)) + np.repeat(first[:-1] * UNIT - offs[:-1], n)] = buf
    return out


def _responses(model: dict, data: np.ndarray) -> np.ndarray:
    """Answers of all filters at every fourth byte of padded data."""
    emb = model["embedding"][data].ravel()  # DIM values a byte
    n = (len(data) - KERNEL) // STRIDE
    view = np.lib.stride_tricks.as_strided(emb, (n, KERNEL * DIM), (4 * STRIDE * DIM, 4))
    out = np.ascontiguousarray(view) @ model["filters"]
    out += model["bias"]
    return np.maximum(out, 0, out=out)


def _chunks(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks of each document, first unit of each chunk, last unit it can hold)."""
    chunks = np.maximum(1, -(-(units - 1) // STEP_UNITS))
    start = np.repeat(first[:-1], chunks) + STEP_UNITS * C.ranges(np.zeros_like(chunks), chunks)
    return chunks, start, np.repeat(first[1:] - 1, chunks)


def features(model: dict, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Means and maxima over chunks of each document's largest answers: (documents, 2 * FILTERS)."""
    units, first = _layout(offs)
    out = _responses(model, _padded(buf, offs, first))
    out[(first[1:] * PLACES) - 1] = 0  # these look across a document's end
    top = out.reshape(-1, PLACES, FILTERS).max(axis=1)
    chunks, start, last = _chunks(units, first)
    best = top[start]
    for k in range(1, CHUNK_UNITS):
        best = np.maximum(best, top[np.minimum(start + k, last)])
    at = np.concatenate(([0], np.cumsum(chunks)[:-1]))
    return np.hstack([np.add.reduceat(best, at, axis=0) / chunks[:, None], np.maximum.reduceat(best, at, axis=0)])


def probability(model: dict, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    z = features(model, buf, offs).astype(np.float64) @ model["out"] + model["intercept"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---------------------------------------------------------------- fitting

def _training_chunks(texts: list[str], chunks: int = 8) -> np.ndarray:
    """Some chunks of each text, evenly spread over it: (texts, chunks, bytes); for _gradients alone."""
    size = UNIT * CHUNK_UNITS
    out = np.zeros((len(texts), chunks, size + KERNEL), np.uint8)
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        for k, a in enumerate(np.linspace(0, max(0, len(raw) - size), chunks).astype(int)):
            part = raw[a: a + size]
            out[i, k, : len(part)] = part
    return out


def train(texts: list[str], labels: list[int], share: float) -> bytes:
    """Fitted parameters; share is the true share of label 1."""
    rng = np.random.default_rng(7)
    y = np.array(labels, np.float64)
    model = {"embedding": rng.normal(0, 0.5, (256, DIM)).astype(np.float32),
             "filters": rng.normal(0, 0.3, (KERNEL * DIM, FILTERS)).astype(np.float32),
             "bias": np.zeros(FILTERS, np.float32), "out": rng.normal(0, 0.3, 2 * FILTERS), "intercept": np.zeros(1)}
    model["embedding"][0] = 0
    share = min(max(share if labels else 0.5, 1e-3), 1 - 1e-3)
    if len(set(labels)) < 2:
        model["out"][:] = 0
        model["intercept"][:] = np.log(share / (1 - share))
        return _dump(model)
    raw = [t.encode() for t in texts]
    names = list(model)
    first = {k: np.zeros_like(model[k], np.float64) for k in names}
    second = {k: np.zeros_like(model[k], np.float64) for k in names}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            own = order[a: a + BATCH]
            grads = _text_gradients(model, [raw[i] for i in own], y[own])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                move = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                model[k] = (model[k] - move).astype(model[k].dtype)
            model["embedding"][0] = 0
    model["intercept"] = model["intercept"] + np.log(share / (1 - share)) - np.log(y.sum() / (len(y) - y.sum()))
    return _dump(model)


def _unit_tops(model: dict, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest answer in each unit of padded data, and its place there."""
    n = int(first[-1])
    top, place = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64)
    for a in range(0, n, SLICE):
        b = min(n, a + SLICE)
        out = _responses(model, data[a * UNIT: b * UNIT + KERNEL])
        ends = first[1:][(first[1:] > a) & (first[1:] <= b)] - a
        out[ends * PLACES - 1] = 0  # these look across a document's end
        out = out.reshape(-1, PLACES, FILTERS)
        place[a:b] = out.argmax(axis=1)
        top[a:b] = np.take_along_axis(out, place[a:b, None], axis=1)[:, 0]
    return top, place


def _text_gradients(model: dict, texts: list[bytes], y: np.ndarray) -> dict:
    """Gradients over all chunks of the texts; of each chunk the places of the largest answers count."""
    buf, offs = C.joined(texts)
    units, first = _layout(offs)
    data = _padded(buf, offs, first)
    top, place = _unit_tops(model, data, first)
    chunks, start, last = _chunks(units, first)
    best, at = top[start], np.repeat(start[:, None], FILTERS, axis=1)
    for k in range(1, CHUNK_UNITS):
        unit = np.minimum(start + k, last)
        at = np.where(top[unit] > best, unit[:, None], at)
        best = np.maximum(best, top[unit])
    begin = np.concatenate(([0], np.cumsum(chunks)[:-1]))
    most = np.maximum.reduceat(best, begin, axis=0)
    feats = np.hstack([np.add.reduceat(best, begin, axis=0) / chunks[:, None], most]).astype(np.float64)
    z = feats @ model["out"] + model["intercept"]
    dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
    dfeat = dz[:, None] * model["out"][None, :]
    dbest = np.repeat(dfeat[:, :FILTERS] / chunks[:, None], chunks, axis=0)
    for f in range(FILTERS):  # of a document's chunks with the largest answer, the first
        found = np.flatnonzero(best[:, f] == np.repeat(most[:, f], chunks))
        doc = np.searchsorted(begin, found, side="right") - 1
        doc, one = np.unique(doc, return_index=True)
        dbest[found[one], f] += dfeat[doc, FILTERS + f]
    dbest *= best > 0
    # chunks that overlap share places; then the sums by byte, place in the filter and filter
    filters = np.arange(FILTERS)
    dtop = np.bincount((at * FILTERS + filters).ravel(), dbest.ravel(), len(top) * FILTERS)
    used = np.flatnonzero(dtop)
    spot = used // FILTERS * UNIT + place.ravel()[used] * STRIDE
    sums = np.stack([np.bincount(data[spot + k].astype(np.int64) * FILTERS + used % FILTERS, dtop[used], 256 * FILTERS)
                     for k in range(KERNEL)]).reshape(KERNEL, 256, FILTERS)
    dfilters = np.einsum("kbf,bd->kdf", sums, model["embedding"], optimize=True).reshape(KERNEL * DIM, FILTERS)
    demb = np.einsum("kbf,kdf->bd", sums, model["filters"].reshape(KERNEL, DIM, FILTERS), optimize=True)
    return {"embedding": demb, "filters": dfilters + 1e-4 * model["filters"], "bias": dbest.sum(axis=0),
            "out": feats.T @ dz + 1e-4 * model["out"], "intercept": np.array([dz.sum()])}


def _gradients(model: dict, data: np.ndarray, y: np.ndarray) -> dict:
    """The same for chunks of one shape, (texts, chunks, bytes); a test holds it against numeric gradients."""
    docs, chunks, width = data.shape
    emb = model["embedding"][data]  # docs, chunks, width, DIM
    n = (width - KERNEL) // STRIDE
    flat = emb.reshape(docs * chunks, -1)
    view = np.lib.stride_tricks.sliding_window_view(flat, KERNEL * DIM, axis=1)[:, :: STRIDE * DIM][:, :n]
    x = np.ascontiguousarray(view)  # docs * chunks, n, KERNEL * DIM
    act = x @ model["filters"] + model["bias"]
    where = act.argmax(axis=1)  # docs * chunks, FILTERS
    best = np.maximum(np.take_along_axis(act, where[:, None, :], axis=1)[:, 0], 0).reshape(docs, chunks, FILTERS)
    top = best.argmax(axis=1)
    feats = np.hstack([best.mean(axis=1), best.max(axis=1)]).astype(np.float64)
    z = feats @ model["out"] + model["intercept"]
    dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / docs
    dfeat = dz[:, None] * model["out"][None, :]
    dbest = np.repeat(dfeat[:, None, :FILTERS] / chunks, chunks, axis=1)
    np.add.at(dbest, (np.arange(docs)[:, None], top, np.arange(FILTERS)[None, :]), dfeat[:, FILTERS:])
    dbest = (dbest * (best > 0)).reshape(docs * chunks, FILTERS)
    picked = x[np.arange(docs * chunks)[:, None], where]  # docs * chunks, FILTERS, KERNEL * DIM
    dfilters = np.einsum("cf,cfk->kf", dbest, picked)
    dpicked = dbest[:, :, None] * model["filters"].T[None]  # docs * chunks, FILTERS, KERNEL * DIM
    rows = data.reshape(docs * chunks, width)
    byte = rows[np.arange(docs * chunks)[:, None, None], where[:, :, None] * STRIDE + np.arange(KERNEL)]
    demb = np.zeros((256, DIM))
    np.add.at(demb, byte.ravel(), dpicked.reshape(-1, DIM))
    return {"embedding": demb, "filters": dfilters + 1e-4 * model["filters"], "bias": dbest.sum(axis=0),
            "out": feats.T @ dz + 1e-4 * model["out"], "intercept": np.array([dz.sum()])}


def _dump(model: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def load(model: bytes) -> dict:
    with np.load(io.BytesIO(model)) as f:
        return {k: f[k] for k in f.files}


# ---------------------------------------------------------------- on Spark

def held_out(doc_id: Column) -> Column:
    return C.crc_remainder(doc_id, 4) == 2


def learn(docs: DataFrame, labels: DataFrame, per_class: int = labelled.PER_CLASS) -> bytes:
    """A model of docs (doc_id, text) and labels (doc_id, quality), without the held-out ids."""
    drawn, share = labelled.sample(docs, labels.where(~held_out(F.col("doc_id"))), per_class)
    return labelled.fit(drawn, lambda texts, marks: train(texts, marks, share))


def score(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text, ...) with held_out, score and predicted."""
    held = C.carry(docs, "doc_id", "text")
    schema = C.extended(held.schema, ("score", "double"))

    def run(batches):
        net = load(model)
        for b in C.steps(batches, max_bytes=C.SMALL_STEP):
            buf, offs = C.text_buffer(b.column(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(probability(net, buf, offs))], names=schema.names)

    out = (held.mapInArrow(run, schema).withColumn("held_out", held_out(F.col("doc_id")))
           .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
    return C.restore(out, "doc_id", "text", "held_out", "score", "predicted")
