"""Packing token sequences into bins of fixed size by swap-based local search.

Documents become token ids plus an end id; longer ones are cut so that only the first piece is
short.  Full pieces fill a bin alone.  The others are dealt at random into groups of bounded size
(their number grows with the input), and each group is packed in one task: a best-fit start, then
local search between underfull bins.  A step moves a document, exchanges one for one, or two for
one, whenever that raises the sum of squared fills; that sum is bounded, so the search ends, and
what it drains are the emptiest bins.

Rows: a null or empty text is the end id alone.  Every row of the input is packed, repeated rows
and null ids included.  Further columns are ignored.
"""
from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.llm import common as C

CAPACITY = 1024
END_ID = 2
#: pieces that are packed in one task
GROUP = 16384
#: letters below are of one class in every Unicode version
_OTHER = re.compile("[\u0250-\U0010ffff]")
#: the byte-level pre-tokenizer's pattern (fixed value)
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """The tokenizer's ids of whole texts.

    A text whose letters are plain Latin, which every Unicode version classes alike, goes through a
    byte-pair encoder made of the same file's vocabulary (its ids are the merge ranks), which takes
    about a third of the time; a text with others or with a special token's string, and any
    vocabulary of another kind, through the tokenizer itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = _rank_encoder(path)

    def slow(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.direct is None or _OTHER.search(text) or any(t in text for t in self.special):
            return self.slow(text)
        return self.direct.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def _rank_encoder(path: str):
    """A byte-pair encoder of a byte-level tokenizer file whose ids are its merge ranks, or None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or file.get("normalizer"):
        return None
    special = {t["content"] for t in file.get("added_tokens", [])}
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    others = [b for b in range(256) if b not in letters]
    byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merges]
    if order != sorted(order) or len(ranks) != 256 + len(merges):
        return None
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs (doc_id, text), the piece's ids not kept."""

    def run(batches):
        encoder = Encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for b in C.steps(batches, max_bytes=C.SMALL_STEP):
            doc, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                raw = encoder.encode(text.as_py() or "").tobytes() + end
                n = len(raw) // 4
                cut = n % capacity or capacity
                edges = [0, *range(cut, n + 1, capacity)]
                for k in range(len(edges) - 1):
                    doc.append(i)
                    piece.append(k)
                    start.append(edges[k])
                    length.append(edges[k + 1] - edges[k])
                    crc.append(zlib.crc32(raw[4 * edges[k]: 4 * edges[k + 1]]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE_SCHEMA)


# ---------------------------------------------------------------- one group

class _Bins:
    """Bins of item lengths, with an index of which underfull bins hold which lengths and pairs."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[dict[int, int]] = []  # bin -> {item: length}
        self.fill: list[int] = []
        # in order, so that the emptiest bin comes first
        self.one: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # length -> (fill, bin, item)
        self.two: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # sum -> (fill, bin, item, item)
        self.one_mask = 0
        self.two_mask = 0

    def start(self, lengths: np.ndarray) -> None:
        """Best fit, longest first; room_mask has a bit for each room that some bin has."""
        rooms: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for item in np.argsort(-lengths, kind="stable").tolist():
            n = int(lengths[item])
            fits = mask >> n
            if fits:
                room = n + (fits & -fits).bit_length() - 1
                at = rooms[room].pop()
                if not rooms[room]:
                    mask &= ~(1 << room)
            else:
                at, room = len(self.items), self.capacity
                self.items.append({})
                self.fill.append(0)
            self.items[at][item] = n
            self.fill[at] += n
            if room > n:
                rooms[room - n].append(at)
                mask |= 1 << (room - n)
        for at in range(len(self.items)):
            self._enter(at, True)

    def _enter(self, at: int, enter: bool) -> None:
        """Put a bin's lengths and pairs into the index, or take them out; full bins are not there.

        Items of one length stand in for each other: one is entered, and two for pairs."""
        if not 0 < self.fill[at] < self.capacity:
            return
        own: dict[int, list[int]] = {}
        for x, n in self.items[at].items():
            same = own.setdefault(n, [])
            if len(same) < 2:
                same.append(x)
        fill, several = self.fill[at], list(own.items())
        sums: dict[int, tuple[int, int]] = {}
        for i, (n, xs) in enumerate(several):
            self._mark("one", n, (fill, at, xs[0]), enter)
            if len(xs) == 2:
                sums.setdefault(2 * n, (xs[0], xs[1]))
            for m, ys in several[i + 1:]:
                sums.setdefault(n + m, (xs[0], ys[0]))
        for n, pair in sums.items():
            self._mark("two", n, (fill, at, *pair), enter)

    def _mark(self, kind: str, n: int, what: tuple, enter: bool) -> None:
        index, mask = getattr(self, kind), f"{kind}_mask"
        if enter:
            insort(index[n], what)
            setattr(self, mask, getattr(self, mask) | 1 << n)
        else:
            own = index[n]
            place = bisect_left(own, what)
            assert own[place] == what
            del own[place]
            if not index[n]:
                setattr(self, mask, getattr(self, mask) & ~(1 << n))

    def _largest(self, kind: str, most: int, least: int, at: int):
        """The largest length in [least, most] held by a bin that is no fuller than bin at."""
        index, mask = getattr(self, kind), getattr(self, f"{kind}_mask")
        mask &= (1 << (most + 1)) - 1
        while mask and (n := mask.bit_length() - 1) >= least:
            for fill, *what in index[n][:2]:  # a bin has one entry of a length
                if what[0] != at and fill <= self.fill[at]:
                    return n, what
            mask &= ~(1 << n)
        return 0, None

    def improve(self, at: int) -> bool:
        """The step that adds most to bin at from a bin that is no fuller, if there is one.

        Every such step raises the sum of squared fills."""
        gap = self.capacity - self.fill[at]
        best, give, take = 0, None, None
        for item, n in [(None, 0), *{n: (x, n) for x, n in self.items[at].items()}.values()]:
            for kind in ("one", "two") if n else ("one",):
                m, what = self._largest(kind, n + gap, n + best + 1, at)
                if what:
                    best, give, take = m - n, item, what
            if best == gap:
                break
        if not best:
            return False
        other = take[0]
        self._enter(at, False)
        self._enter(other, False)
        for x in take[1:]:
            self.items[at][x] = self.items[other].pop(x)
        if give is not None:
            self.items[other][give] = self.items[at].pop(give)
        self.fill[at] += best
        self.fill[other] -= best
        self._enter(at, True)
        self._enter(other, True)
        return True

    def search(self) -> None:
        """Fullest bins first, until no step raises the squared fill."""
        again = True
        while again:
            again = False
            order = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda b: -self.fill[b])
            for at in order:
                while 0 < self.fill[at] < self.capacity and self.improve(at):
                    again = True


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; bins are numbered from 0 without gaps."""
    bins = _Bins(capacity)
    bins.start(lengths)
    bins.search()
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for number, items in enumerate(x for x in bins.items if x):
        at = 0
        for item, n in items.items():
            where[item], offset[item] = number, at
            at += n
    return where, offset


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    cut = C.staged(pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    short = cut.where(F.col("length") < capacity)
    groups = short.count() // group + 1
    number = F.monotonically_increasing_id()
    full = cut.where(F.col("length") == capacity).withColumn("sequence_id", -1 - number).withColumn(
        "offset", F.lit(0).cast("long"))
    dealt = short.withColumn("g", F.pmod(F.xxhash64(number), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        where, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        g = table.column("g")[0].as_py()
        return table.drop_columns(["g"]).append_column("sequence_id", pa.array((g << 32) + where)).append_column(
            "offset", pa.array(offset))

    packed = dealt.groupBy("g").applyInArrow(run, PIECE_SCHEMA + ", sequence_id long, offset long")
    return packed.unionByName(full)
