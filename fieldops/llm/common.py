"""What the operators share: words, Arrow buffers, rolling hashes, shared scratch tables."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: a word: a run of bytes that are neither blank nor tab, LF, VT, FF, CR (fixed by the contracts)
WORD = r"[^\x20\x09-\x0D]+"
#: bytes of text that one vectorised step takes at a time; a longer document is a step of its own
STEP_BYTES = 1 << 20
#: the same where a step holds many times its text (hashes, filters' answers) or texts stay compressed until then
SMALL_STEP = 1 << 17
#: bytes of rows that Spark hands to a Python worker at once
BATCH_BYTES = 4 << 20
M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Unset: a temporary folder on a local master (tests); on a cluster an error, because each
    executor would write to its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = spark.sparkContext.getCheckpointDir()
        if not found:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fieldops-llm-"))
            found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of BATCH_BYTES at most, from now on in this session.

    Spark's own limit (10,000 rows or 64 MB) holds a batch of texts in the JVM's buffers and the worker's at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, f"{BATCH_BYTES}b")


NO_ID = -(1 << 63)


def with_key(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with the key (did, tk) of a document: its id (null sorts first) and, if
    rows with other texts share that id, a hash of the text (else 0).

    Rows with the same id and text are one document; rows that share only the id stay apart."""
    several = staged(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), F.lit(True).alias("several")), "ids")
    did = docs.withColumn("did", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    return (did.join(several, "did", "left")
            .withColumn("tk", F.when(F.col("several"), digest).otherwise(F.lit(0).cast("long"))).drop("several"))


def squeezed(docs: DataFrame) -> DataFrame:
    """docs with ``text`` replaced by ``z``, compressed row by row: for shuffles, which it halves."""
    others = [c for c in docs.columns if c != "text"]
    schema = extended(docs.select(*others).schema, ("z", "binary"))

    def run(batches):
        codec = pa.Codec("zstd", 1)
        for b in steps(batches, max_bytes=SMALL_STEP):
            rest = [b.column(i) for i, name in enumerate(b.schema.names) if name != "text"]
            raw = b.column(b.schema.get_field_index("text")).cast(pa.large_binary()).fill_null(b"")
            z = [np.int64(len(x)).tobytes() + codec.compress(x, asbytes=True) for x in raw.to_pylist()]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(z, pa.binary())], names=schema.names)

    return docs.select(*others, "text").mapInArrow(run, schema)


def expanded(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of a batch with ``z``, as UTF-8."""
    codec = pa.Codec("zstd")
    return [codec.decompress(x[8:], decompressed_size=int(np.frombuffer(x[:8], np.int64)[0]), asbytes=True)
            for x in batch.column(batch.schema.get_field_index("z")).to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end and their offsets, as text_buffer() gives them."""
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offs


def crc_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


# ---------------------------------------------------------------- Arrow buffers

def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column laid end to end and the n + 1 offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    arr = col.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]: offs[-1]], offs - offs[0]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text",
          max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about max_bytes of text, so that memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        i = batch.schema.get_field_index(text)
        _, offs = text_buffer(batch.column(i))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, offsets by document) of all words in a text buffer."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


# ---------------------------------------------------------------- hashes (wrapping 64-bit)

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
LOWER_VALUES = BYTE_VALUES[LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        steps_ = np.full(max(n, SMALL_STEP + 1, 0 if have is None else 2 * len(have)), base, np.uint64)
        steps_[0] = 1
        _POW[base] = have = np.multiply.accumulate(steps_)
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of a sequence of 64-bit values, from which any range hashes."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_R, len(values)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for arrays of ranges; depends on the values in them alone."""
    return mix((prefix[end] - prefix[start]) * _powers(_R_INV, len(prefix))[start])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    return range_hash(prefix_hash((LOWER_VALUES if lower else BYTE_VALUES)[buf]), starts, ends)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length) end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return first + np.arange(total)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def long_list(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offs = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values))


# ---------------------------------------------------------------- columns that are passed on

ROW = "_row"


def carry(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator uses, and all others folded into one struct, where their names
    cannot clash with the operator's own."""
    others = [c for c in docs.columns if c not in used]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("_"))
    return docs.select(*used, row.alias(ROW))


def restore(df: DataFrame, *outputs: str) -> DataFrame:
    """Unfold what carry() folded; of a name that is also an output's, the output stays."""
    taken = {c.lower() for c in outputs}
    fields = [f for f in df.schema[ROW].dataType.names if f.lower() not in taken and f != "_"]
    return df.select(*outputs, *[F.col(f"{ROW}.`{f}`") for f in fields])


def extended(schema: StructType, *fields: tuple[str, str]) -> StructType:
    out = StructType(list(schema.fields))
    for name, kind in fields:
        out = out.add(name, kind)
    return out
