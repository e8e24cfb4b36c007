"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long hash string: symbol by symbol, the signed axis nearest to the
vector after a random rotation of the tree's own (cross-polytope hashing, seven bits a symbol).  A
tree is the array of all strings in order, so vectors that share a prefix lie side by side.

A query descends in every tree to its longest matching prefix, with the two next nearest axes of
the first symbol as further strings; then all trees ascend together, one bit at a time, until the
ranges under the prefixes hold enough candidates.  Candidates are ranked by exact cosine.

Enough is a share of all vectors, since without structure the neighbours lie in a share of them.
It is counted in distinct vectors: a tree holds each once, and strings of a query that share a
prefix count once, so that entries / trees is a number of vectors that are surely there.

Trees are cut into cells by their first bits, for each vector length by its own number of vectors,
and cells that hold more are dealt over several tasks, each with a sorted array of its own: prefix
ranges simply add up.  A query whose own cells hold too few goes on ascending over the cells that
share a shorter prefix, to the whole tree if need be.  Equal vectors are one entry, which keeps as many of its
smallest ids as an answer can show; queries with equal vectors share one search.

Rows: vectors that are null, empty, zero or hold a null or non-finite component take no part.
Vectors of different length are never compared.  A null id is no query and no answer.  Rows with
the query's own id are no candidates; an id that occurs with the same vector twice counts once.
Fewer than k candidates: all are returned.  Further columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fieldops.llm import common as C

K = 5
TREES, PROBES, SYMBOLS, BITS = 16, 3, 4, 7
#: ranges are widened until they surely hold so many distinct vectors, and this share of all
CANDIDATES, SHARE = 1024, 0.02
#: entries of a cell that are searched in one task, at most
CELL_ROWS = 20_000
#: products of entries and queries that a task holds at a time
PRODUCTS = 1_000_000
DEPTH = SYMBOLS * BITS


def _rotation(dim: int, tree: int, level: int) -> np.ndarray:
    """dim x 64: random directions, orthogonal where the dimension allows."""
    g = np.random.default_rng([20, tree, level, dim]).normal(size=(dim, max(64, dim)))
    return np.linalg.qr(g.T)[0].T[:, :64] if dim < 64 else np.linalg.qr(g)[0][:, :64]


class _Hasher:
    def __init__(self):
        self.rotations: dict[tuple[int, int, int], np.ndarray] = {}

    def symbols(self, x: np.ndarray, tree: int, level: int, first: int) -> np.ndarray:
        """The `first` nearest signed axes of each vector, nearest first: (n, first)."""
        key = (x.shape[1], tree, level)
        if key not in self.rotations:
            self.rotations[key] = _rotation(*key)
        y = x @ self.rotations[key]
        size = np.abs(y)
        axes = size.argmax(axis=1)[:, None] if first == 1 else np.argsort(-size, axis=1)[:, :first]
        return np.where(np.take_along_axis(y, axes, axis=1) > 0, 64, 0) + axes

    def strings(self, x: np.ndarray, tree: int, probes: int) -> np.ndarray:
        """Hash strings as numbers: (n, probes); they differ in the first symbol alone."""
        head = self.symbols(x, tree, 0, probes).astype(np.int64)
        tail = np.zeros(len(x), np.int64)
        for level in range(1, SYMBOLS):
            tail = (tail << BITS) | self.symbols(x, tree, level, 1)[:, 0]
        return (head << (BITS * (SYMBOLS - 1))) | tail[:, None]


def valid(vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
    v = F.col(embedding)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0))


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """(rep, ids, v): each distinct vector, its smallest id and the `keep` smallest.

    Batches are reduced before anything is shuffled, and again under a salt."""
    elem = vectors.schema["v"].dataType

    def local(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lists = b.column(1)
            flat, offs = np.ascontiguousarray(lists.flatten().to_numpy()), lists.offsets.to_numpy()
            offs = offs - offs[0]
            found: dict[bytes, list[int]] = {}
            for i in np.argsort(ids, kind="stable").tolist():
                own = found.setdefault(flat[offs[i]: offs[i + 1]].tobytes(), [])
                if len(own) < keep and (not own or ids[own[-1]] != ids[i]):
                    own.append(i)
            yield b.take(pa.array(sorted(i for own in found.values() for i in own), pa.int64()))

    schema = C.extended(vectors.select("vec_id", "v").schema)
    few = vectors.select("vec_id", "v").mapInArrow(local, schema).withColumn("salt", F.pmod(F.hash("vec_id"), F.lit(64)))
    smallest = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, keep)
    once = few.groupBy("v", "salt").agg(smallest(F.collect_list("vec_id")).alias("ids"))
    both = once.groupBy("v").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids"))
    return both.select(F.col("ids")[0].alias("rep"), "ids", F.col("v").cast(elem))


def _by_length(lists: pa.Array):
    """(rows, matrix) of vectors of each length, as doubles scaled to length one."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.cumsum(n) - n
    for dim in np.unique(n).tolist():
        rows = np.flatnonzero(n == dim)
        x = flat[(at[rows][:, None] + np.arange(dim))]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def strings(points: DataFrame, probes: int, cell_bits: dict[int, int]) -> DataFrame:
    """(tree, dim, cell, code, ...) for each string of each vector of points (..., v).

    cell_bits: how many first bits are the cell, by vector length."""
    schema = C.extended(points.schema, ("tree", "integer"), ("dim", "integer"), ("cell", "integer"), ("code", "long"))
    place = points.columns.index("v")

    def run(batches):
        hasher = _Hasher()
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                for rows, x in _by_length(part.column(place)):
                    own = part.take(pa.array(rows))
                    for tree in range(TREES):
                        codes = hasher.strings(x, tree, probes)
                        for p in range(probes):
                            code = codes[:, p]
                            n = len(code)
                            yield pa.RecordBatch.from_arrays(
                                [*own.columns, pa.array(np.full(n, tree, np.int32)),
                                 pa.array(np.full(n, x.shape[1], np.int32)),
                                 pa.array((code >> (DEPTH - cell_bits[x.shape[1]])).astype(np.int32)), pa.array(code)],
                                names=schema.names)

    return points.mapInArrow(run, schema)


def _sorted_codes(table: pa.Table):
    """Split a group into entries (sorted by string) and queries."""
    is_query = table.column("query").to_numpy()
    entries, queries = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
    return entries.sort_by("code"), queries


def _range(codes: np.ndarray, code: np.ndarray, depth) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings lie that share the first `depth` bits with code."""
    low = (code >> (DEPTH - depth)) << (DEPTH - depth)
    return np.searchsorted(codes, low), np.searchsorted(codes, low + (np.int64(1) << (DEPTH - depth)))


def _products(x: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(i, x[lo[i]:hi[i]] @ q[i]) for all i; queries with one range are multiplied together."""
    order = np.lexsort((hi, lo))
    cuts = np.flatnonzero(np.concatenate(([True], (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0), [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = lo[order[a]], hi[order[a]]
        step = max(1, PRODUCTS // max(1, int(high - low)))
        for at in range(a, b, step):
            own = order[at: min(b, at + step)]
            yield from zip(own.tolist(), q[own] @ x[low:high].T)


KEYS = ("dim", "tree", "cell", "salt")


def _once(reps: np.ndarray, code: np.ndarray, depth) -> np.ndarray:
    """Places of a query's strings, of those that share the first `depth` bits the first alone."""
    prefix = code >> (DEPTH - depth)
    order = np.lexsort((prefix, reps))
    again = np.zeros(len(order), bool)
    again[1:] = (reps[order][1:] == reps[order][:-1]) & (prefix[order][1:] == prefix[order][:-1])
    return np.sort(order[~again])


def search(vectors: DataFrame, queries: DataFrame, k: int = K, candidates: int = CANDIDATES, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of vectors (vec_id, embedding) found for each row
    of queries (vec_id, embedding)."""
    keep = k + 1
    every = valid(vectors.where("vec_id is not null")).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    asked = valid(queries.where("vec_id is not null")).select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").alias("v"))
    points = C.staged(distinct_vectors(every, keep), "vectors")
    enough, cell_bits = {}, {}
    for dim, n in points.groupBy(F.size("v")).count().collect():  # a row for each vector length
        enough[dim] = TREES * max(1, min(n, max(candidates, math.ceil(share * n))))
        # cells of such a depth that the strings of a query find about four times the candidates in theirs
        cell_bits[dim] = max(0, min(DEPTH - 1, int(math.log2(max(1.0, n * TREES * PROBES / (4 * enough[dim]))))))
    lengths = F.broadcast(vectors.sparkSession.createDataFrame(
        [(dim, n, cell_bits[dim]) for dim, n in enough.items()], "dim int, enough long, bits int"))
    wanted = C.staged(asked.dropDuplicates().join(points.select("rep", "v"), "v").select("query_id", "rep", "v"), "asked")
    probes = wanted.select("rep", "v").dropDuplicates(["rep", "v"])

    entries = strings(points, 1, cell_bits)
    cells = C.staged(entries.groupBy("dim", "tree", "cell").agg(
        F.count("*").alias("held"), F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("salts")), "cells")
    many = cells.where("salts > 1").drop("held")
    salted = lambda found: found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    dealt = (entries.join(many, ["dim", "tree", "cell"], "left")
             .withColumn("salt", F.pmod(F.hash("rep"), F.coalesce("salts", F.lit(1)))).drop("salts"))
    hashed = C.staged(strings(probes, PROBES, cell_bits), "probes")
    spread = salted(hashed.join(cells.drop("held"), ["dim", "tree", "cell"]))
    # cells by the prefixes of their own, down to none: (dim, tree, depth, prefix, cell, held, salts)
    above = cells.join(lengths, "dim").withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("bits")))).withColumn(
        "prefix", F.expr("cast(shiftright(cell, bits - depth) as long)")).drop("enough", "bits")

    # 1. how many entries the prefixes hold at each depth, over all trees
    def count(table: pa.Table) -> pa.Table:
        own, ask = _sorted_codes(table)
        codes, every, reps = own.column("code").to_numpy(), ask.column("code").to_numpy(), ask.column("rep").to_numpy()
        rep, depth, held = [], [], []
        for d in range(cell_bits[ask.column("dim")[0].as_py()] if len(every) else DEPTH + 1, DEPTH + 1):
            one = _once(reps, every, d) if d < BITS else np.arange(len(every))
            lo, hi = _range(codes, every[one], d)
            some = np.flatnonzero(hi > lo)
            rep.append(reps[one[some]])
            depth.append(np.full(len(some), d, np.int32))
            held.append((hi - lo)[some])
        at = np.zeros(0, np.int64)
        return pa.table({"rep": np.concatenate([at, *rep]), "depth": np.concatenate([at.astype(np.int32), *depth]),
                         "n": np.concatenate([at, *held])})

    light = dealt.select(*KEYS, "code", "rep", F.lit(False).alias("query")).unionByName(
        spread.select(*KEYS, "code", "rep", F.lit(True).alias("query")))
    held = light.groupBy(*KEYS).applyInArrow(count, "rep long, depth int, n long").groupBy("rep", "depth").agg(
        F.sum("n").alias("n"))
    goal = F.broadcast(lengths.select("dim", "enough"))
    within = probes.select("rep", F.size("v").alias("dim")).join(goal, "dim").join(held, "rep", "left").groupBy("rep").agg(
        F.max(F.when(F.col("n") >= F.col("enough"), F.col("depth"))).alias("depth"))
    within = C.staged(within, "within")
    # queries with too few in their own cells ascend over the cells around; at depth 0 these hold all
    short = (hashed.join(within.where("depth is null").select("rep"), "rep").join(lengths, "dim")
             .withColumn("depth", F.explode(F.expr("if(bits > 0, sequence(0, bits - 1), array(0))")))
             .select("rep", "dim", "enough", "tree", "depth", F.expr("cast(shiftright(cell, bits - depth) as long)").alias("prefix")).distinct())
    sums = above.groupBy("dim", "tree", "depth", "prefix").agg(F.sum("held").alias("held"))
    around = (short.join(sums, ["dim", "tree", "depth", "prefix"]).groupBy("rep", "enough", "depth").agg(F.sum("held").alias("n"))
              .groupBy("rep").agg(F.max(F.when(F.col("n") >= F.col("enough"), F.col("depth"))).alias("depth")))
    depths = C.staged(within.where("depth is not null").unionByName(around), "depths")
    # a prefix shorter than a cell's goes to all cells under it, once; at depth 0 a single tree holds all
    aimed = (hashed.join(depths, "rep").join(lengths.drop("enough"), "dim").where("depth > 0 or tree = 0")
             .withColumn("own", F.col("depth")).withColumn("depth", F.least("own", "bits"))
             .withColumn("prefix", F.expr("cast(shiftright(cell, bits - depth) as long)")).drop("bits", "cell"))
    aimed = aimed.where("own > depth").unionByName(
        aimed.where("own = depth").dropDuplicates(["rep", "tree", "prefix"]))
    aimed = salted(aimed.join(above.drop("held"), ["dim", "tree", "depth", "prefix"])).withColumn("depth", F.col("own"))

    # 2. the nearest of what lies under the prefixes at that depth
    def nearest(table: pa.Table) -> pa.Table:
        own, ask = _sorted_codes(table)
        ask = ask.take(pa.array(_once(ask.column("rep").to_numpy(), ask.column("code").to_numpy(), ask.column("depth").to_numpy())))
        codes, code = own.column("code").to_numpy(), ask.column("code").to_numpy()
        reps, depth = ask.column("rep").to_numpy(), ask.column("depth").to_numpy()
        out_q, out_i, out_s = [], [], []
        if len(codes) and len(code):
            (_, x), = _by_length(own.column("v"))
            (_, q), = _by_length(ask.column("v"))
            lo, hi = _range(codes, code, depth)
            entry = own.column("rep").to_numpy()
            for i, s in _products(x, q, lo, hi):
                take = np.arange(len(s))
                if len(s) > keep:  # all that tie with the last, then the smaller ids
                    take = np.flatnonzero(s >= np.partition(s, -keep)[-keep] - 1e-12)
                take = take[np.lexsort((entry[lo[i] + take], -(x[lo[i] + take] * q[i]).sum(axis=1)))][:keep]
                out_q.append(np.full(len(take), reps[i]))
                out_i.append(lo[i] + take)
                out_s.append((x[lo[i] + take] * q[i]).sum(axis=1))
        at = np.concatenate(out_i) if out_i else np.zeros(0, np.int64)
        return pa.table({"rep": pa.array(np.concatenate(out_q) if out_q else at, pa.int64()),
                         "found": own.column("rep").take(pa.array(at, pa.int64())),
                         "ids": own.column("ids").take(pa.array(at, pa.int64())),
                         "fv": own.column("v").take(pa.array(at, pa.int64()))})

    kind = points.schema["v"].dataType.simpleString()
    heavy = dealt.select(*KEYS, "code", "rep", "ids", "v", F.lit(False).alias("query"), F.lit(0).alias("depth")).unionByName(
        aimed.select(*KEYS, "code", "rep", F.lit(None).cast("array<bigint>").alias("ids"), "v",
                                          F.lit(True).alias("query"), "depth"))
    found = heavy.groupBy(*KEYS).applyInArrow(nearest, f"rep long, found long, ids array<bigint>, fv {kind}")
    found = found.groupBy("rep", "found").agg(F.first("ids").alias("ids"), F.first("fv").alias("fv"))
    scored = found.join(probes, "rep").select("rep", "ids", cosine(F.col("v"), F.col("fv")).alias("score"))
    # of each distinct query the entries that an answer can come from, then the answers of each query id
    best = W.partitionBy("rep").orderBy(F.col("score").desc(), F.col("ids")[0])
    top = C.staged(scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep).drop("r"), "top")
    answers = wanted.select("query_id", "rep").join(top, "rep").select("query_id", "score", F.explode("ids").alias("vec_id"))
    answers = answers.where("vec_id <> query_id").dropDuplicates(["query_id", "vec_id", "score"])
    rank = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def cosine(a, b):
    """Cosine in double precision."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
