"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 23, 23 and 18 bits.  If two fingerprints differ in at
most three bits, the two segments with the fewest differences differ in at most one bit each (two
or more in the second would make four in all).  The binary Golay code of length 23 is perfect:
every 23-bit word lies within three bits of exactly one codeword.  So the codeword index of one
fingerprint's segment is among those to which the other's segment, or a word one bit from it,
decodes: one index if the word lies within two bits of its codeword, six if it lies at three.  A
fingerprint is stored under one key for each pair of segments and looked up under the products of
the several, the pairs that meet are verified by their bit distance, and links become components.

Only distinct fingerprints are compared, so copies never multiply.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: (lowest bit, bits) of the segments
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code (fixed value)
GENERATOR = 0b101011100011


# ---------------------------------------------------------------- fingerprints

def _fingerprint(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of each run of n words (all of them, if fewer), as 64-bit numbers."""
    line = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -n] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[n - 1:].tolist())),
                       np.uint64, len(words) - n + 1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs (text, ...) with ``fp`` (long): bit i is 1 if it is set in over half the shingles' hashes.

    A null or wordless text has fingerprint 0."""
    schema = C.extended(docs.schema, ("fp", "long"))

    def run(batches):
        for b in C.steps(batches, max_bytes=C.SMALL_STEP):
            buf, offs = C.text_buffer(b.column(b.schema.get_field_index("text")))
            low = C.LOWER[buf].tobytes()
            hashes, counts = [], np.zeros(b.num_rows, np.int64)
            for i in range(b.num_rows):
                words = low[offs[i]: offs[i + 1]].split()
                if words:
                    hashes.append(_fingerprint(words, shingle))
                    counts[i] = len(hashes[-1])
            fp = np.zeros(b.num_rows, np.uint64)
            if hashes:
                full = np.flatnonzero(counts)
                at = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
                every = np.concatenate(hashes)
                for bit in range(64):
                    ones = np.add.reduceat((every >> np.uint64(bit)) & np.uint64(1), at)
                    fp[full] |= (2 * ones.astype(np.int64) > counts[full]).astype(np.uint64) << np.uint64(bit)
            yield pa.RecordBatch.from_arrays([*b.columns, C.signed(fp)], names=schema.names)

    return docs.mapInArrow(run, schema)


# ---------------------------------------------------------------- Golay keys

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def _error_patterns() -> np.ndarray:
    """The pattern of at most three bits that has each syndrome."""
    one = 1 << np.arange(23)
    i, j, k = np.meshgrid(*[np.append(one, 0)] * 3, indexing="ij")
    patterns = np.unique((i | j | k).ravel())
    table = np.zeros(2048, np.int64)
    table[_syndromes(patterns)] = patterns
    return table


_ERRORS = _error_patterns()
_LOW = _syndromes(np.arange(1 << 12))
_HIGH = _syndromes(np.arange(1 << 11) << 12)


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    syndrome = _LOW[words & 0xFFF] ^ _HIGH[words >> 12]
    return (words ^ _ERRORS[syndrome]) >> 11


def nearby(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codeword indices of each word and its one-bit neighbours: (n x (bits + 1), used)."""
    flips = np.concatenate(([0], 1 << np.arange(bits)))
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    used = np.ones(found.shape, bool)
    used[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, used


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    u = fps.view(np.uint64)
    return [((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]


PAIRS = ((0, 1), (0, 2), (1, 2))


def golay_keys(distinct: DataFrame, probe: bool) -> DataFrame:
    """(key, fp) of distinct fingerprints (fp): one key a pair of segments, or all to look under."""

    def emit(fps: np.ndarray):
        segments = _segments(fps)
        if not probe:
            own = [decode(s) for s in segments]
            for p, (i, j) in enumerate(PAIRS):
                yield (p << 24) | (own[i] << 12) | own[j], fps
            return
        sets = [nearby(s, n) for s, (_, n) in zip(segments, SEGMENTS)]
        lists = []
        for found, used in sets:  # ragged lists of indices
            lists.append((found[used], used.sum(axis=1)))
        for p, (i, j) in enumerate(PAIRS):
            (a, na), (b, nb) = lists[i], lists[j]
            a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
            n = na * nb
            row = np.repeat(np.arange(len(fps)), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            key = (p << 24) | (a[a0[row] + k // nb[row]] << 12) | b[b0[row] + k % nb[row]]
            yield key, fps[row]

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fps), 4096):
                for key, fp in emit(fps[at: at + 4096]):
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(fp)], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key int, fp long")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most max_bits (3 or fewer).

    Both sides hold many keys a fingerprint, which the planner cannot know: it takes them for as small as their
    input and would send them through the driver.  So they are sorted and merged, as are the joins of ids
    with documents below."""
    if max_bits > 3:
        raise ValueError("three segments promise keys in common for up to 3 bits")
    stored = golay_keys(distinct, probe=False).withColumnRenamed("fp", "a")
    looked = golay_keys(distinct, probe=True).withColumnRenamed("fp", "b")
    met = stored.hint("merge").join(looked, "key").where((F.col("a") < F.col("b")) & (distance(F.col("a"), F.col("b")) <= max_bits))
    return met.select("a", "b").distinct()


# ---------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): root is the smallest node that can be reached.

    Alternating large-star and small-star steps: each is an aggregate and a join, so a node with
    millions of neighbours is never gathered in one task."""
    edges = C.staged(edges.select("a", "b").where("a != b"), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = C.staged(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
                         .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def with_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """docs (doc_id, fp, ...) as fingerprints() gives them, with ``component_id``: the smallest
    doc_id that links reach, null if all those ids are null."""
    first = C.staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    linked = links(first, max_bits)
    roots = components(linked)
    near = first.join(roots.hint("merge"), first.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    near = C.staged(near, "near")
    named = near.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = near.join(named.hint("merge"), "root").select("fp", "component_id")
    return docs.join(ids.hint("merge"), "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, tk, fp, component_id), one row per row of docs (doc_id, text).

    Copies, repeated rows and texts without words (fingerprint 0) are linked like any others.
    A null doc_id takes part, but is never the smallest.  Further columns are ignored."""
    keyed = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("tk", F.xxhash64("text"))
    small = C.staged(fingerprints(keyed, shingle).select("doc_id", "tk", "fp"), "fingerprints")
    return with_components(small, shingle, max_bits)
